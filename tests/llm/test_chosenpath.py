"""Components against brute force, at every depth of the trees; how many pairs one tree loses."""

import random
import re

import numpy as np
import pytest

from granero.llm import chosenpath as cp


def brute(rows):
    sets = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append((i, {tuple(w[j : j + 4]) for j in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set())))
    group = list(range(len(rows)))
    for a, (_, x) in enumerate(sets):
        for b, (_, y) in enumerate(sets[:a]):
            if x and y and group[a] != group[b] and 100 * len(x & y) >= 80 * len(x | y):
                group = [group[b] if g == group[a] else g for g in group]
    smallest = {}
    for g, (i, _) in zip(group, sets, strict=True):
        smallest[g] = i if smallest.get(g) is None else smallest[g] if i is None else min(i, smallest[g])
    out = [(i, len(s), smallest[g] if s else i) for g, (i, s) in zip(group, sets, strict=True)]
    return sorted(((i, n, c, i == c) for i, n, c in out), key=str)


def result(frame, **options):
    return sorted((tuple(r) for r in cp.near_duplicates(frame, **options).drop("text_hash").collect()), key=str)


def edited(words, rate, rnd):
    return [w if rnd.random() > rate else f"e{rnd.randrange(10**6)}" for w in words]


@pytest.fixture(scope="module")
def mixed():
    """Groups at all distances around the limit, chains, exact copies, a passage that many share, short texts."""
    rnd = random.Random(3)
    passage, texts = [f"p{i}" for i in range(80)], []
    for group in range(30):
        base = [f"g{group}w{rnd.randrange(3000)}" for _ in range(rnd.choice([5, 30, 90, 200]))]
        base += passage if group % 2 else []
        texts.append(base)
        for _ in range(rnd.randrange(1, 9)):
            texts.append(edited(rnd.choice(texts[-3:]) if group % 3 else base, rnd.choice([0.0, 0.01, 0.02, 0.027, 0.04]), rnd))
    near = [f"w{i}" for i in range(120)]
    texts += [edited(near, rnd.choice([0.01, 0.02, 0.025, 0.03]), rnd) for _ in range(60)] + [near] * 40
    texts += [passage + [f"own{i}"] for i in range(6)] + [["solo"], ["Solo"], ["a", "b", "c", "d"], ["a", "b", "c"]]
    rnd.shuffle(texts)
    return [(i * 7 % 1009, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("options", [{}, {"depth": 3, "leaf_pairs": 20}, {"depth": 1, "leaf_pairs": 0}])
def test_components_equal_brute_force(docs, mixed, options, monkeypatch):
    """As it is; with several levels of branching; with nodes that are compared in blocks because they may not branch."""
    monkeypatch.setattr(cp, "BLOCK", 8)
    assert result(docs(mixed), **options) == brute(mixed)


def test_odd_rows_and_an_empty_table(docs, odd):
    assert result(odd) == brute([(r["doc_id"], r["text"]) for r in odd.collect()])
    assert result(docs([(1, "a")]).limit(0)) == []
    alone = [(3, "nothing like the others at all"), (4, None), (None, None), (5, "completely different words stand here")]
    assert result(docs(alone)) == brute(alone)


def test_trees_meet_their_recall():
    """Pairs of similarity 0.8 in a node that branches down to six levels: one tree loses a tenth, four hardly any."""
    rnd = np.random.default_rng(5)
    common, own = 800, 100  # |A and B| / |A or B| = 0.8
    lost, pairs = np.zeros(cp.TREES), 150
    for _ in range(pairs):
        shared = rnd.integers(0, 2**63, common, dtype=np.uint64)
        tokens = np.stack([cp.minwise(np.concatenate([shared, rnd.integers(0, 2**63, own, dtype=np.uint64)])) for _ in range(2)])
        for tree in range(cp.TREES):
            nodes = {(0, tree << cp.POOL)}
            for _ in range(6):
                nodes = {
                    (int(name[0]), int(path[0]))
                    for node, way in nodes
                    for name, path in cp._children(np.array([node, node]), np.array([way, way]), tokens)
                    if name[0] == name[1]
                }
            lost[tree] += not nodes
    assert lost.mean() / pairs < 0.14 and lost.max() / pairs < 0.2  # 0.1 expected


def test_tokens_estimate_similarity():
    rnd = np.random.default_rng(6)
    shared = rnd.integers(0, 2**63, 5000, dtype=np.uint64)
    sets = [np.concatenate([shared[: 5000 - 50 * i], rnd.integers(0, 2**63, 50 * i, dtype=np.uint64)]) for i in range(40)]
    tokens = np.stack([cp.minwise(s) for s in sets])
    for i in range(1, 40):
        similarity = (5000 - 50 * i) / (5000 + 50 * i)
        assert abs((tokens[0] == tokens[i]).mean() - similarity) < 0.2
