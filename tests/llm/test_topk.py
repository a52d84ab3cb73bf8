import math

import numpy as np
import pytest

from granero.llm import topk
from tests.conftest import plan


def brute(rows, k=10):
    usable = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if (i, tuple(v)) not in usable:
            usable.append((i, tuple(v)))
    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in usable]
    out = []
    for q in sorted({i for i, _ in whole if i % 100 == 0}):
        qv = max(v for i, v in whole if i == q)
        scores = sorted((-sum(a * b for a, b in zip(qv, v)), i) for i, v in whole if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    return out


def result(spark, rows, kind="float", k=10):
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, score string, rank int" if len(rows[0]) == 4 else f"vec_id long, embedding array<{kind}>")
    return sorted(tuple(r) for r in topk.top_k(frame, frame.where("vec_id % 100 = 0"), k).select("query_id", "rank", "vec_id", "score").collect())


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "RANGE", 150)
    rnd = np.random.default_rng(0)
    rows = [(i, [float(np.float32(x)) for x in rnd.normal(0, 0.2, 8)]) for i in range(450)]
    rows += [(1000 + i, [0.5] * 8) for i in range(30)]  # ties
    assert result(spark, rows) == brute(rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.1, 0.2]), (100, None), (200, [None, 1.0]), (300, [nan, 0.0]), (400, [inf, 0.0]), (None, [1.0, 1.0]),
            (1, [0.3, -0.4]), (1, [0.3, -0.4]), (2, [-0.5, 0.5]), (2, [0.5, 0.5]), (-100, [0.0, -0.1]), (500, [0.25]), (3, [])]
    padded = [(i, v if v is None else (v + [0.0] * (2 - len(v)))) for i, v in rows]
    assert result(spark, rows, "double") == brute(padded)
    big = [(0, [1e12, 1.0]), (1, [1e12, 1.0]), (2, [-1e3, 5e9]), (3, [1e9, 1e9])]
    expected = [(q, r, i, max(-(2**63), min(2**63 - 1, s))) for q, r, i, s in brute(big)]
    assert result(spark, big, "double") == expected


def test_empty_and_few(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(frame, frame).count() == 0
    assert result(spark, [(100, [1.0])]) == []


def test_groups_of_queries_meet_all_cells_without_a_join(spark, monkeypatch):
    for name, value in (("RANGE", 100), ("CELL", 150), ("QUERIES", 20), ("GROUP_BYTES", 30 * 8 * 8)):
        monkeypatch.setattr(topk, name, value, raising=False)
    rnd = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rnd.integers(-3, 4, 8)]) for i in range(0, 9000, 20)]  # many ties, 90 queries
    assert result(spark, rows) == brute(rows)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    shown = plan(topk.top_k(frame, frame.where("vec_id % 100 = 0")))
    assert "Broadcast" not in shown and "Join" not in shown  # queries times ranges would come to the driver


def test_products_beyond_64_bits_are_held_at_the_limits(spark):
    rnd = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rnd.normal(0, 1e13, 4)]) for i in range(300)]
    held = lambda s: max(-(2**63), min(2**63 - 1, s))
    whole = {i: [math.floor(1024 * x) for x in v] for i, v in rows}
    for q in (0, 100, 200):
        best = sorted((-held(sum(a * b for a, b in zip(whole[q], v))), i) for i, v in whole.items() if i != q)[:10]
        assert [r for r in result(spark, rows, "double") if r[0] == q] == [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]


def test_blocks_are_pruned_and_the_result_stays():
    rnd = np.random.default_rng(3)
    rows = np.repeat(rnd.integers(-900, 900, (40, 6)), 64, axis=0) + rnd.integers(-30, 30, (2560, 6))
    ids, queries = np.arange(2560), rows[::500]
    floor = np.full(len(queries), np.iinfo(np.int64).min)
    found, reached, scored = topk.search_range(ids[::500], queries, ids, rows, 10, floor)
    assert scored < len(queries) * 20  # of 40 blocks each
    for q in range(len(queries)):
        exact = sorted((-int(s), int(i)) for i, s in zip(ids, rows @ queries[q]) if i != ids[::500][q])[:10]
        assert sorted((-s, i) for a, i, s in found if a == ids[::500][q]) == exact
        assert reached[q] == -exact[-1][0]


@pytest.mark.parametrize("scale", [1, 2**30])
def test_products_are_exact(scale):
    a = np.array([[3, -5]]) * scale
    b = np.array([[7, 2], [-1, 9]]) * scale
    exact = [[sum(int(x) * int(y) for x, y in zip(a[0], r)) for r in b]]
    assert topk._product(a, b).tolist() == [[max(-(2**63), min(2**63 - 1, v)) for v in exact[0]]]
