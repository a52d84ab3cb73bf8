import zlib

import numpy as np
import pytest

from granero.llm import packing

HARD = [None, "", "plain words here", "É 你好 🙂 x y  z\t\n\r\n", "<|endoftext|> inside", "'s 've I'LL 123 4567 ___ --", "a" * 5000, "\x00\x01"]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.default_vocabulary())


def check(rows, pieces, tokenizer, size):
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    for doc_id, own in by_doc.items():
        text = dict(rows)[doc_id]
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for p in sorted(own, key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at == size or (at < size and at & (at - 1) == 0)  # no padding anywhere
    assert set(by_doc) == {i for i, _ in rows}


@pytest.mark.parametrize("size", [16, 2048])
def test_every_id_lies_in_one_piece(docs, tokenizer, size):
    rows = [(i, HARD[i % len(HARD)] if i < 16 else f"text number {i} " * (i % 50)) for i in range(120)]
    pieces = packing.pack(docs(rows), size=size).collect()
    check(rows, pieces, tokenizer, size)


def test_repeated_rows_null_ids_and_empty_table(docs):
    frame = docs([(1, "same text"), (1, "same text"), (None, "no id"), (None, None)])
    pieces = packing.pack(frame).collect()
    assert sorted((p["doc_id"] or 0, p["doc_tokens"]) for p in pieces if p["start"] == 0) == [(0, 1), (0, 3), (1, 3), (1, 3)]
    assert packing.pack(frame.limit(0)).count() == 0


def test_encoder_equals_tokenizers(tokenizer):
    encode = packing.load_encoder(packing.default_vocabulary())
    for text in [t for t in HARD if t]:
        assert list(encode(text)) == tokenizer.encode(text, add_special_tokens=False).ids


def test_curve_visits_neighbours():
    bits = 3
    points = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    keys = packing.hilbert_key(points, bits)
    assert sorted(keys.tolist()) == list(range(512))
    walk = points[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_rest_is_cut_into_powers_of_two():
    for rest in (0, 1, 7, 1024, 2047):
        assert sum(packing.rest_lengths(rest)) == rest and all(n & (n - 1) == 0 for n in packing.rest_lengths(rest))
