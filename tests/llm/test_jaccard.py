import random
import re

import pytest

from granero.llm import jaccard
from granero.llm.components import components


def brute(rows):
    sets = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append((i, {tuple(w[j : j + 5]) for j in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())))
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                root[find(a)] = find(b)
    out = []
    for a, (i, s) in enumerate(sets):
        group = [sets[b][0] for b in range(len(rows)) if find(b) == find(a) and sets[b][0] is not None]
        out.append((i, len(s), i if not s else (min(group) if group else None)))
    return sorted(out, key=str)


def result(frame):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(frame).collect()), key=str)


def edited(words, rate, rnd):
    return [w if rnd.random() > rate else f"e{rnd.randrange(10**6)}" for w in words]


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_equal_brute_force(docs, seed):
    """Groups of copies at all distances around the limit, chains, shared passages, short texts."""
    rnd = random.Random(seed)
    passage = [f"p{i}" for i in range(50)]
    rows, texts = [], []
    for group in range(12):
        base = [f"g{group}w{rnd.randrange(3000)}" for _ in range(rnd.choice([6, 20, 60, 150]))]
        if group % 3 == 0:
            base += passage
        texts.append(base)
        for _ in range(rnd.randrange(1, 14)):
            texts.append(edited(rnd.choice(texts[-3:]) if group % 2 else base, rnd.choice([0.0, 0.01, 0.02, 0.03, 0.05]), rnd))
    texts += [["solo"], ["Solo"], ["a", "b", "c", "d"], ["a", "b", "c"]]
    rnd.shuffle(texts)
    rows = [(i * 3 % 1009, " ".join(t)) for i, t in enumerate(texts)]
    assert result(docs(rows)) == brute(rows)


def test_a_large_group_around_the_limit(docs):
    """Copies of one text that link to it or just not, and hardly to each other, beside many exact copies."""
    rnd = random.Random(7)
    base = [f"w{i}" for i in range(120)]
    texts = [edited(base, rnd.choice([0.01, 0.02, 0.025, 0.03, 0.035]), rnd) for _ in range(220)] + [base] * 60
    texts += [edited(texts[0], 0.02, rnd) for _ in range(20)]
    rnd.shuffle(texts)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    assert result(docs(rows)) == brute(rows)


def test_links_beside_a_centre_that_links_to_nothing(docs):
    """A text that shares most of its few leading shingles is the centre; the others link without it."""
    shared = [f"s{i}" for i in range(12)]
    long = [f"l{i}" for i in range(60)]
    texts = [shared, long + shared + ["x"], long + shared + ["y"], long[:30] + shared, ["q", *shared, "r", "t"]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    assert result(docs(rows)) == brute(rows)


def test_odd_rows(odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert result(odd) == brute(rows)


def test_empty_table_and_keep_one(docs, odd):
    empty = docs([(1, "a")]).limit(0)
    assert result(empty) == []
    assert jaccard.keep_one(empty).count() == 0
    kept = jaccard.keep_one(odd)
    assert kept.columns == odd.columns
    got = sorted(((r["doc_id"], (r["text"] or "")[:5]) for r in kept.collect()), key=str)
    assert got == sorted([(1, ""), (2, ""), (3, "  \n\t "[:5]), (4, "w0 w1"), (None, "no id"), (None, ""), (6, "one"), (8, "É ü ß")], key=str)


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 200), (None, 3), (301, 300), (301, 300)]
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    expected = {i: 0 for i in range(61)} | {100 + i: 100 for i in range(30)} | {300: 300, 301: 300}
    assert {r["node"]: r["root"] for r in got} == expected and len(got) == len(expected)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_all_links_of_a_group_are_listed(docs):
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join([*words[:190 - i], *(f"own{i}x{j}" for j in range(4))])) for i in range(8)]
    rows += [(20, " ".join(words[:190] + [f"own0x{j}" for j in range(4)])), (21, "nothing like the others at all here"), (22, None)]
    sets = {}
    for i, text in rows:
        found = (text or "").split()
        sets[i] = {tuple(found[p : p + jaccard.SHINGLE]) for p in range(max(len(found) - jaccard.SHINGLE, 0) + 1)}
    wanted = {(i, j) for i in range(8) for j in range(i) if 4 * len(sets[i] & sets[j]) >= 3 * len(sets[i] | sets[j])}
    assert len(wanted) == 8 * 7 / 2
    classes, links, counts = jaccard.all_links(docs(rows))
    of = {r["class"]: r["doc_id"] for r in classes.where("class IS NOT NULL AND doc_id <> 20").collect()}
    found = [tuple(sorted((of[r["a"]], of[r["b"]]), reverse=True)) for r in links.collect()]
    assert sorted(found) == sorted(wanted)
    assert {of[r["class"]]: r["n_links"] for r in counts.collect()} == {**dict.fromkeys(range(8), 7), 21: 0}
    assert jaccard.jaccard_links(docs(rows))[1].count() < len(wanted)  # connects them with fewer


def test_one_row_of_each_group_stays_whatever_its_id(docs):
    """Groups of null ids, and near copies that share an id."""
    base, other = [f"w{i}" for i in range(60)], [f"z{i}" for i in range(60)]
    rows = [(None, " ".join(base)), (None, " ".join([*base, "x"])), (7, " ".join(other)), (7, " ".join([*other, "y"])), (9, " ".join(["q", *other]))]
    kept = [(r["doc_id"], r["text"]) for r in jaccard.keep_one(docs([*rows, (None, None), (9, "")])).collect()]
    assert sorted(str(i) for i, t in kept) == ["7", "9", "None", "None"]
    assert sum(t is not None and t.startswith("w0") for _, t in kept) == 1


def test_regions_too_large_for_a_task(docs, monkeypatch):
    rnd = random.Random(11)
    base = [f"w{i}" for i in range(120)]
    texts = [edited(base, rnd.choice([0.01, 0.02, 0.03, 0.035]), rnd) for _ in range(90)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    monkeypatch.setattr(jaccard, "REGION_MEMBERS", 10)
    monkeypatch.setattr(jaccard, "REGION_BLOCK", 8)
    assert result(docs(rows)) == brute(rows)
