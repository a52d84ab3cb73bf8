import random
import re

import numpy as np
import pytest

from granero.llm import decontaminate as dc

PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text):
    return re.findall(PATTERN, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, items):
    out = []
    for i, text in rows:
        w = words(text)
        hit, names = set(), set()
        for name, item in items:
            v = words(item)
            n = min(13, len(v))
            windows = {tuple(v[s : s + n]) for s in range(len(v) - n + 1)} if v else set()
            found = [s for s in range(len(w) - n + 1) if tuple(w[s : s + n]) in windows]
            if windows and found:
                hit |= {p for s in found for p in range(s, s + n)}
                if name is not None:
                    names.add(str(name))
        out.append((i, len(w), len(hit), sorted(names), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def result(frame, items, **kw):
    got = dc.contamination(frame, items, **kw).collect()
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], list(r["item_ids"]), r["contaminated"]) for r in got), key=str)


@pytest.fixture(scope="module")
def case(spark, docs):
    rnd = random.Random(4)
    vocabulary = [f"v{i}" for i in range(40)]
    item = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(item(n))) for i, n in enumerate([13, 14, 30, 45, 12, 7, 3, 2, 1, 20])]
    items += [(50, "same same " * 15), (51, None), (52, ""), (53, "..."), (54, items[2][1]), (3, "another text of the third " * 4), (None, "nameless " + items[0][1])]
    rows = []
    for i in range(60):
        text = [rnd.choice(vocabulary + ["ü", "É"]) for _ in range(rnd.choice([0, 5, 40, 300]))]
        for _ in range(rnd.randrange(3)):
            v = (items[rnd.randrange(10)][1]).split()
            a = rnd.randrange(len(v))
            text[rnd.randrange(len(text) + 1) : 0] = [x.upper() for x in v[a : a + rnd.choice([12, 13, 14, 40])]]
        rows.append((i, ", ".join(text)))
    rows += [(90, "same " * 400), (91, None), (92, ""), (92, ""), (None, items[1][1]), (93, items[3][1]), (93, items[3][1])]
    return rows, items, docs(rows), spark.createDataFrame(items, "item_id long, text string")


def test_equals_brute_force(case):
    rows, items, frame, benchmark = case
    assert result(frame, benchmark) == brute(rows, items)


def test_large_benchmarks_are_joined(case):
    rows, items, frame, benchmark = case
    assert result(frame, benchmark, in_scan=0) == brute(rows, items)


def test_filter_empty_tables_and_odd_rows(case, odd):
    rows, items, frame, benchmark = case
    kept = dc.decontaminate(frame, benchmark)
    bad = {r[0] for r in brute(rows, items) if r[4]}
    assert kept.columns == frame.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == sorted((i for i, _ in rows if i not in bad), key=str)
    assert dc.contamination(frame.limit(0), benchmark).count() == 0
    assert all(r["n_hit"] == 0 for r in dc.contamination(odd, benchmark.limit(0)).collect())
    assert dc.contamination(odd, benchmark).count() == odd.count()


@pytest.mark.parametrize("window", range(1, 14))
def test_every_shared_window_shares_a_fingerprint(window):
    rnd = np.random.default_rng(window)
    k = dc.gram_size(window)
    for _ in range(50):
        shared = rnd.integers(0, 3, window)
        a = np.concatenate([rnd.integers(0, 3, 9), shared, rnd.integers(0, 3, 5)])
        b = np.concatenate([rnd.integers(0, 3, 2), shared])
        prints = []
        for text in (a, b):
            grams = np.array([hash(tuple(text[i : i + k])) & (2**63 - 1) for i in range(len(text) - k + 1)], np.uint64)
            prints.append(set(grams[dc.winnow(grams, window - k + 1)].tolist()))
        assert prints[0] & prints[1]
