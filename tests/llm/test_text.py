import re

import numpy as np
import pyarrow as pa
import pytest

from granero.llm import text as tx


def words(text, pattern):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return re.findall(pattern, folded)


@pytest.mark.parametrize(
    "inside,pattern", [(tx.NOT_BLANK, r"[^\x20\x09-\x0D]+"), (tx.ALPHANUMERIC, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")]
)
def test_words_equal_the_pattern(inside, pattern, monkeypatch):
    monkeypatch.setattr(tx, "SLICE", 64)  # cuts fall inside texts
    texts = ["", None, "Ab  cd\nEF", "x" * 500 + " y", "É-é ü a.B,c", " ", "a" * 64, "b c " * 100, "🙂 ok\x0bgo"]
    column = pa.array(texts)
    seen = {}
    row = 0
    for low, high, data, offsets in tx.slices(column):
        got = tx.words_of(data, offsets, inside)
        for i in range(low, high):
            own = slice(got.first[i - low], got.first[i - low + 1])
            found = [bytes(data[a:b]).decode() for a, b in zip(got.starts[own], got.ends[own])]
            expected = words(texts[i] or "", pattern)
            assert [re.sub("[A-Z]", lambda m: m[0].lower(), f) for f in found] == expected
            for word, value in zip(expected, got.hashes[own].tolist()):
                assert seen.setdefault(word, value) == value
        row = high
    assert row == len(texts)
    assert len(set(seen.values())) == len(seen)


def test_gram_hashes_depend_on_order_and_length():
    column = pa.array(["a b c", "c b a", "a b", "a b c"])
    data, offsets = tx.buffers(column)
    got = tx.words_of(data, offsets, tx.NOT_BLANK)
    grams = got.grams(3)
    assert grams[0] == grams[got.first[3]] and grams[0] != grams[got.first[1]]
    assert got.grams(2)[0] == got.grams(2)[got.first[2]]
    assert len(got.grams(100)) == 0


def test_sliced_column_and_ragged():
    column = pa.array(["zero", "one two", None, "three"]).slice(1, 3)
    data, offsets = tx.buffers(column)
    assert np.diff(tx.words_of(data, offsets, tx.NOT_BLANK).first).tolist() == [2, 0, 1]
    values, owner = tx.ragged(np.array([5, 0, 2]), np.array([7, 0, 3]))
    assert values.tolist() == [5, 6, 2] and owner.tolist() == [0, 0, 2]
