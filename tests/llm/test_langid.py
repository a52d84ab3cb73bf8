import random

import numpy as np
import pytest

from granero.llm import langid

SYLLABLES = {"xx": ["la", "mo", "ri", "su"], "yy": ["kro", "tsch", "ünd", "ald"], "zz": ["éa", "ou", "iè", "ñe"]}


def text_of(lang, n, rnd):
    return " ".join("".join(rnd.choice(SYLLABLES[lang]) for _ in range(rnd.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def case(spark):
    rnd = random.Random(5)
    rows = [(i, text_of(lang, rnd.choice([3, 40, 300]), rnd), lang) for i, lang in enumerate(list(SYLLABLES) * 40)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_gradients_equal_differences():
    rnd = np.random.default_rng(0)
    model = langid.fresh(["a", "b", "c"], hidden=3)
    steps, wanted = rnd.integers(0, 5, (7, 4)).astype(np.uint8), np.array([0, 1, 2, 1])
    _, gradients = langid.loss_and_gradients(model, steps, wanted)
    for p, g in zip(langid._parameters(model), gradients):
        for _ in range(6):
            at = tuple(rnd.integers(0, s) for s in p.shape) if p.shape[0] != 256 else (int(rnd.integers(0, 5)), int(rnd.integers(0, p.shape[1])))
            kept, e = p[at], 1e-5
            p[at] = kept + e
            up = langid.loss_and_gradients(model, steps, wanted)[0]
            p[at] = kept - e
            down = langid.loss_and_gradients(model, steps, wanted)[0]
            p[at] = kept
            assert abs((up - down) / (2 * e) - g[at]) < 1e-6


def test_fast_reader_equals_training_network():
    rnd = np.random.default_rng(1)
    model = langid.fresh(["a", "b"], hidden=4)
    windows = rnd.integers(0, 256, (5, 9)).astype(np.uint8)
    f, _ = langid._read(model.forward, windows.T)
    b, _ = langid._read(model.backward, windows.T[::-1])
    logits = np.concatenate([f, b[::-1]], axis=2) @ model.output + model.offset
    p = np.exp(logits) / np.exp(logits).sum(axis=2, keepdims=True)
    assert np.allclose(langid._Reader(model).probabilities(windows), p, atol=1e-5)


def test_held_out_accuracy_and_positions(case):
    rows, frame = case
    model = langid.fit(frame.where("doc_id % 4 <> 1").select("text", "lang"), rounds=120)
    got = {r["doc_id"]: r for r in langid.predict(frame, model, positions=True).collect()}
    aside = [r for r in rows if r[0] % 4 == 1]
    assert np.mean([got[i]["lang_pred"] == lang for i, _, lang in aside]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got.values())
    for i, text, _ in aside[:10]:
        ends = [(x["start"], x["end"]) for x in got[i]["labels"]]
        assert ends[0][0] == 0 and ends[-1][1] == len(text.encode())
        assert all(a[1] == b[0] for a, b in zip(ends, ends[1:]))
    mixed = text_of("xx", 200, random.Random(1)) + " " + text_of("yy", 200, random.Random(1))
    runs = langid.predict(frame.sparkSession.createDataFrame([(1, mixed)], "doc_id long, text string"), model, positions=True).first()["labels"]
    share = lambda lo, hi, name: sum(min(hi, r["end"]) - max(lo, r["start"]) for r in runs if r["lang"] == name and r["end"] > lo and r["start"] < hi)
    half = len(text_of("xx", 200, random.Random(1)))
    assert share(0, half, "xx") > 0.9 * half


def test_odd_rows_and_no_model(case, odd, docs):
    rows, frame = case
    model = langid.fit(frame.limit(30).select("text", "lang"), rounds=3)
    got = [tuple(r) for r in langid.predict(odd, model).collect()]
    assert len(got) == odd.count()
    und = {i for i, name, _ in got if name == "und"}
    assert {1, 2, 3} <= und and not und & {4, 5, 6, 7, 8}
    assert langid.predict(odd.limit(0), model).count() == 0
    assert langid.fit(frame.limit(0).select("text", "lang")) is None
    assert {r["lang_pred"] for r in langid.predict(odd, None).collect()} == {"und"}
    lonely = langid.predict(docs([(1, "1234 -- 77"), (2, "x")]), model).collect()
    assert [r["lang_pred"] == "und" for r in sorted(lonely)] == [True, False]
