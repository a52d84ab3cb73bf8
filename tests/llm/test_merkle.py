"""The manifest against a plain tree, on every kind of row and on blocks so small that several tiers are needed."""

import hashlib

import pytest
from pyspark.sql import functions as F

from granero.llm import merkle


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return digest(*["-" if row[c] is None else f"{len(str(row[c]).encode())}:{row[c]}" for c in merkle.FIELDS])


def plain_tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def plain_manifest(rows):
    by_lang = {}
    for row in rows:
        by_lang.setdefault(row["lang"], []).append((row["doc_id"] is not None, row["doc_id"] or 0, plain_leaf(row)))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {lang: plain_tree([h for *_, h in sorted(by_lang[lang])]) for lang in langs}
    top = plain_tree([trees[lang][-1][0] for lang in langs])
    out = []
    for rank, lang in enumerate(langs):
        for place, (known, doc_id, leaf) in enumerate(sorted(by_lang[lang])):
            siblings = []
            for levels, i in ((trees[lang], place), (top, rank)):
                for row in levels[:-1]:
                    siblings += row[i ^ 1 : (i ^ 1) + 1]
                    i >>= 1
            out.append((doc_id if known else None, lang, leaf, trees[lang][-1][0], top[-1][0], digest(*siblings)))
    return out


def ordered(rows):
    return sorted(rows, key=repr)


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, f"text {i} é" * (i % 5), ["de", "en", "en", None, "Z", "é"][i % 6], "s", i) for i in range(60)]
    data += [(7, "again", "en", "s", 1), (7, "again", "en", "s", 1), (7, None, "en", None, None)]  # ties and repeated rows
    data += [(None, "no id", "de", "s", 3), (None, None, None, None, None), (900, "", "alone", "", 0), (-5, "x" * 200_000, "en", "s", 2**63 - 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    return spark.createDataFrame(data, schema).selectExpr("*", "'clash' AS leaf", "1 AS idx", "2 AS tree", "3 AS block")


@pytest.mark.parametrize("bits", [1, 3, 12])
def test_equals_a_plain_tree(rows, bits):
    got = merkle.manifest(rows, bits=bits).collect()
    assert ordered(tuple(r)[:6] for r in got) == ordered(plain_manifest(rows.collect()))
    assert all(r["verified"] and r["folded_root"] == r["root"] for r in got)


def test_a_changed_row_does_not_verify(rows):
    changed = F.when(F.col("doc_id") % 7 == 0, merkle.leaf(n_chars=F.col("n_chars") + 1))
    for r in merkle.manifest(rows.where("n_chars < 1000"), changed, bits=2).collect():
        assert r["verified"] == (r["doc_id"] is None or r["doc_id"] % 7 != 0)
        assert len(r["folded_root"]) == 64


@pytest.mark.parametrize("n", [0, 1, 2])
def test_few_rows(rows, n):
    few = rows.where("lang = 'alone' OR doc_id = -5").orderBy("doc_id").limit(n)
    got = merkle.manifest(few).collect()
    assert ordered(tuple(r)[:6] for r in got) == ordered(plain_manifest(few.collect()) if n else [])


@pytest.mark.parametrize("n", [1, 2, 5, 8, 13])
def test_multiproof_is_smallest_and_enough(n):
    """Every set of leaves: none of the fetched nodes can be derived from the others, and all proofs fold to the root."""
    nodes = [[digest(str(i)) for i in range(n)]]
    nodes = [[bytes.fromhex(h) for h in level] for level in plain_tree(nodes[0])]
    for chosen in range(1, 2**n, 3):
        known = [i for i in range(n) if chosen >> i & 1]
        wanted = merkle.missing(known, n)
        assert len(set(wanted)) == len(wanted)
        under = {(level, i): {x for x in range(n) if x >> level == i} for level, i in wanted}
        assert all(not leaves & set(known) for leaves in under.values())
        assert sum(map(len, under.values())) + len(known) == n  # they and the leaves cover the tree, nothing twice
        rows = merkle.derive({i: nodes[0][i] for i in known}, {(level, i): nodes[level][i] for level, i in wanted}, n)
        assert rows[-1] == {0: nodes[-1][0]}
        assert all(merkle.fold(nodes[0][i], i, merkle.proof(rows, i, n)) == nodes[-1][0] for i in known)
