import random

import numpy as np
import pyarrow as pa
import pytest

from granero.llm import text as tx, toxicity


@pytest.fixture(scope="module")
def case(spark, docs):
    rnd = random.Random(2)
    plain = [f"word{i}" for i in range(400)]
    bad = [f"vile{x}" for x in ("ando", "ero", "ito", "azo", "ucho")] + ["grunk"]
    rows, labels = [], []
    for i in range(600):
        text = [rnd.choice(plain) for _ in range(rnd.choice([10, 60, 200]))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(rnd.randrange(2, 6)):
                text.insert(rnd.randrange(len(text)), rnd.choice(bad))
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    return rows, labels, docs(rows), spark.createDataFrame(labels, "doc_id long, label int")


def test_held_out_accuracy_and_evidence(case):
    rows, labels, frame, table = case
    model = toxicity.fit(frame, table.where("doc_id % 5 <> 0"))
    got = {r["doc_id"]: r for r in toxicity.score(frame, model).collect()}
    wanted = dict(labels)
    aside = [i for i in wanted if i % 5 == 0]
    assert np.mean([(got[i]["score"] >= 0.5) == wanted[i] for i in aside]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert all(wanted[e["doc_id"]] == 1 for i in aside if wanted[i] for e in got[i]["evidence"][:3])
    mean = np.mean([got[i]["score"] for i in aside])
    assert abs(mean - np.mean([wanted[i] for i in aside])) < 0.05  # calibrated
    kept = toxicity.reject(frame, model)
    assert kept.columns == frame.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i in got if got[i]["score"] < 0.5}


def test_unseen_ending_of_a_known_beginning(case, docs):
    rows, labels, frame, table = case
    model = toxicity.fit(frame, table)
    got = toxicity.score(docs([(1, "word1 word2 vilexyz word3 vileabc word9"), (2, "word1 word2 word3")]), model)
    scores = {r["doc_id"]: r["score"] for r in got.collect()}
    assert scores[1] > 0.5 > scores[2]


def test_search_is_exact_and_prunes(case):
    rows, labels, frame, table = case
    model = toxicity.fit(frame, table)
    rnd = np.random.default_rng(1)
    scored = []
    for _ in range(40):
        at = np.sort(rnd.choice(len(model.terms), min(5, len(model.terms)), replace=False))
        weights = rnd.random(len(at)).astype(np.float32)
        best, similarity, n = toxicity.nearest(model, at, weights, 5)
        every = weights @ model.weights[at]
        order = np.lexsort((np.arange(len(every)), -every))
        order = order[every[order] > 0][:5]
        assert np.allclose(similarity, every[order], atol=1e-5)
        scored.append(n)
    assert min(scored) < model.maxima.shape[1]


def test_odd_rows_and_missing_labels(spark, case, odd):
    rows, labels, frame, table = case
    model = toxicity.fit(frame, spark.createDataFrame(labels + [(None, 1), (3, None), (5, 7), (10**9, 1)], "doc_id long, label int"))
    got = toxicity.score(odd, model).collect()
    assert len(got) == odd.count() and all(0 <= r["score"] < 0.5 for r in got)
    assert toxicity.score(odd.limit(0), model).count() == 0
    none = toxicity.fit(frame, table.limit(0))
    assert {r["score"] for r in toxicity.score(odd, none).collect()} == {0.0}
    one = toxicity.fit(frame, table.where("label = 1"))
    assert {r["score"] for r in toxicity.score(odd, one).collect()} == {1.0}
    assert toxicity.score(odd, toxicity.fit(frame.limit(0), table)).count() == odd.count()


def test_bounds_of_the_examples_are_not_cut(spark, docs):
    rows = [(i, f"plain{i % 50} text{i % 31} body{i % 7}" + (" vileness grunk" if i < 40 else "")) for i in range(1840)]
    labels = spark.createDataFrame([(i, int(i < 40)) for i, _ in rows], "doc_id long, label int")
    model = toxicity.fit(docs(rows), labels)
    assert (len(model.ids), int(model.toxic.sum())) == (1840, 40)
    assert (toxicity.EXAMPLES, toxicity.VOCABULARY) == (2000, 4096)


def test_whole_vectors_find_copies_without_telling_terms(spark, docs):
    rnd = random.Random(5)
    rows = [(i, " ".join(f"plain{rnd.randrange(300)}" for _ in range(20)) + (" vileness grunk" if i < 30 else "")) for i in range(300)]
    rows += [(900, "quiet marks of nothing known"), (901, "some other harmless line here")]
    frame = docs(rows)
    model = toxicity.fit(frame, spark.createDataFrame([(i, int(i < 30 or i == 900)) for i, _ in rows], "doc_id long, label int"))
    copies = docs([(i + 10_000, t) for i, t in rows])
    got = {r["doc_id"] - 10_000: {e["doc_id"]: e["similarity"] for e in r["evidence"]} for r in toxicity.score(copies, model).collect()}
    for i in (100, 250, 900, 901):  # without a term that tells the labels apart
        assert abs(got[i][i] - 1) < 1e-5
    beyond = toxicity.score(docs([(1, "quiet marks of nothing known"), (2, "quiet marks of nothing known zzz")]), model).collect()
    near = {r["doc_id"]: r["evidence"][0]["similarity"] for r in beyond}
    assert near[2] < near[1]  # a word of no example lengthens the vector


def test_neighbours_and_scores_equal_brute_force(spark, docs):
    """TF-IDF of words and their beginnings, norms with unseen words, cosines, votes and the curve, all by dictionaries."""
    rnd = random.Random(8)
    words = [f"palabra{i}" for i in range(60)] + ["uno", "dos", "tres", "vileness", "grunkiest"]
    rows = [(i, " ".join(rnd.choices(words[:63] if i % 4 else words, k=rnd.randrange(3, 25))) + f" solo{i}") for i in range(160)]
    labels = {i: int(i % 4 == 0) for i in range(0, 160, 2)}
    frame = docs(rows)
    model = toxicity.fit(frame, spark.createDataFrame(list(labels.items()), "doc_id long, label int"))

    def counts(text):
        found = {}
        for word in text.split():
            for term in {word} | {f"{word[:n]}~" for n in toxicity.STEMS if len(word) > n}:
                found[term] = found.get(term, 0) + 1
        return found

    terms = {i: counts(text) for i, text in rows}
    known = {t for i in labels for t in terms[i]}
    held = {t: sum(t in terms[i] for i, _ in rows) for t in known}
    idf = {t: np.log((1 + len(rows)) / (1 + held[t])) + 1 for t in known}
    unseen = np.log((1 + len(rows)) / 2) + 1

    def vector(found):
        v = {t: (1 + np.log(n)) * idf.get(t, unseen) for t, n in found.items()}
        norm = np.sqrt(sum(w * w for w in v.values()))
        return {t: w / norm for t, w in v.items() if t in known}

    vectors = {i: vector(terms[i]) for i in terms}
    for r in toxicity.score(frame, model).collect():
        cosine = {i: sum(w * vectors[i].get(t, 0) for t, w in vectors[r["doc_id"]].items()) for i in labels}
        kth = sorted(cosine.values())[-toxicity.NEIGHBOURS]
        got = {e["doc_id"]: e["similarity"] for e in r["evidence"]}
        assert {i for i, c in cosine.items() if c > kth + 1e-5} <= set(got)
        later = list(got)[toxicity.NEIGHBOURS :]  # neighbours by whole vectors alone
        assert all(abs(got[i] - cosine[i]) < 1e-5 and cosine[i] >= kth - 1e-5 for i in later)
        whole = sorted(cosine, key=lambda i: (-round(cosine[i], 6), list(model.ids).index(i)))[: toxicity.NEIGHBOURS]
        order = [list(model.ids).index(i) for i in whole]
        told = [list(model.ids).index(e) for e in list(got)[: toxicity.NEIGHBOURS] if e not in later]
        votes = toxicity._votes(model, np.array(order), np.array([cosine[i] for i in whole]))
        assert len(told) <= toxicity.NEIGHBOURS and votes[0] == 1.0
    assert np.allclose([model.counts_for[list(model.ids).index(i)] for i in labels], 1.0)


def test_term_numbers():
    rnd = np.random.default_rng(3)
    for n in (0, 1, 2, 7, 5000):
        terms = np.unique(rnd.integers(0, 2**64, n, dtype=np.uint64))
        found = np.concatenate([rnd.choice(terms, 50) if n else terms, rnd.integers(0, 2**64, 300, dtype=np.uint64), np.array([0, 2**64 - 1], np.uint64)])
        place, hit = toxicity.Terms(terms)(found)
        assert (hit == np.isin(found, terms)).all() and (terms[place[hit]] == found[hit]).all()


def test_whole_vectors_are_searched_without_bounds(spark, docs):
    """More documents than are multiplied at once, with rare and dense terms; bounds per block are made for telling terms alone."""
    rnd = random.Random(12)
    words = [" ".join(f"palabra{min(int(rnd.paretovariate(0.6)), 3000)} raro{rnd.randrange(5000)}" for _ in range(20)) for _ in range(640)]
    rows = [(i, text + (" vileness grunk" if i % 5 == 0 else "")) for i, text in enumerate(words)]
    model = toxicity.fit(docs(rows), spark.createDataFrame([(i, int(i % 5 == 0)) for i, _ in rows[:400]], "doc_id long, label int"))
    texts = pa.array([None, ""] + [t for _, t in rows] + ["unknown"], pa.string())
    scores, ids, values = toxicity._score_batch(model, texts)
    assert "blocks" not in vars(model) and "blocks" in vars(model.telling)
    assert len(texts) > 2 * toxicity.TOGETHER and len(model.terms) > toxicity.DENSE  # several products, and terms beyond them
    dense = model.weights[np.arange(len(model.terms))]
    _, _, data, offsets = next(tx.slices(texts))
    at, owner, times, rest = toxicity._looked_up(data, offsets, model.numbers)
    weights = (1 + np.log(times)) * model.idf[at]
    weights /= np.sqrt(np.bincount(owner, weights**2, len(texts)) + rest * model.unseen**2)[owner]
    for doc in range(2, len(texts) - 1):
        own = owner == doc
        cosine = weights[own] @ dense[at[own]]
        kth = np.sort(cosine)[-toxicity.NEIGHBOURS]
        found = dict(zip(ids[doc].tolist(), values[doc].tolist(), strict=True))
        at_least = {int(model.ids[e]) for e in np.flatnonzero(cosine > kth + 2e-6)}
        assert at_least <= set(found)
        told = weights[own] @ (dense[at[own]] * model.marks[at[own]][:, None])
        by_id = {int(i): (c, t) for i, c, t in zip(model.ids, cosine, told, strict=True)}
        assert all(min(abs(v - c) for c in by_id[i]) < 2e-6 for i, v in found.items())
    assert not any(len(ids[i]) for i in (0, 1, -1)) and scores[0] == scores[1] == scores[-1]


def test_documents_that_hold_a_term_count_once():
    terms = np.unique(toxicity._term_counts(*tx.buffers(pa.array(["alfa beta gamma alfabeto"])))[0])
    texts = pa.array(["alfa alfa beta", None, "nada", "alfabeto alfabet alfa", "gamma"])
    data, offsets = tx.buffers(texts)
    found, owner, _ = toxicity._term_counts(data, offsets)
    wanted = np.array([len({int(d) for t, d in zip(found, owner, strict=True) if t == term}) for term in terms])
    at = toxicity._held(data, offsets, toxicity.Terms(terms))
    assert (np.bincount(at, minlength=len(terms)) == wanted).all() and wanted.max() == 2
    assert not len(toxicity._held(*tx.buffers(pa.array([None, "nada"], pa.string())), toxicity.Terms(terms)))
