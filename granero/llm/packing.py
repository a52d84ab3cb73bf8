"""Packing along a space-filling curve.

Each text is turned into token ids. Its bag of tokens, seen as a hashed vector
with one random direction per token id, is projected to ``DIMENSIONS`` numbers;
their place on a Hilbert curve orders the documents, so documents with similar
words become neighbours. The documents are range-partitioned by that key and
every partition fills sequences with its documents one behind the other.

The last sequence of a partition would be partly empty. As a sequence needs no
padding when its length is a power of two, its rest is cut into powers of two,
so nothing is padded at all.
"""

from __future__ import annotations

import base64
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granero.session import stage

DIMENSIONS = 3
BITS = 16  # of each dimension
SEQUENCE = 2048
END_ID = 1
RANGE_BYTES = 32 << 20
_PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, curve_key long"
)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def load_encoder(path: str):
    """A function from a text to its ids, as ``tokenizers`` gives them without special tokens added.

    Byte-level vocabularies that lie beside a rank file of the same name are
    encoded with ``tiktoken``, which gives the same ids several times faster.
    Texts that hold a special token's string go to ``tokenizers`` itself.
    """
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(path)
    ranks_path = os.path.splitext(path)[0] + ".tiktoken"
    if not os.path.exists(ranks_path):
        return lambda text: slow.encode(text, add_special_tokens=False).ids
    import public_tokenizers
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding(
        ranks_path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    with open(path) as file:
        specials = [token["content"] for token in json.load(file).get("added_tokens", [])]

    def encode(text: str):
        if any(special in text for special in specials):
            return slow.encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


_encoders: dict = {}


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Distance along the Hilbert curve of rows of unsigned coordinates below ``2 ** bits``.

    Gray-code construction: walk the bits from the top, rotating and reflecting
    the lower bits of every axis, then interleave the axes.
    """
    axes = [points[:, d].astype(np.uint64) for d in range(points.shape[1])]
    one = np.uint64(1)
    for level in range(bits - 1, 0, -1):
        bit, low = one << np.uint64(level), (one << np.uint64(level)) - one
        for d in range(len(axes)):
            high = (axes[d] & bit) != 0
            swap = np.where(high, 0, (axes[0] ^ axes[d]) & low).astype(np.uint64)
            axes[0] = np.where(high, axes[0] ^ low, axes[0] ^ swap)
            axes[d] = axes[d] ^ swap if d else axes[0]
    for d in range(1, len(axes)):
        axes[d] = axes[d] ^ axes[d - 1]
    turn = np.zeros(len(points), np.uint64)
    for level in range(bits - 1, 0, -1):
        bit = one << np.uint64(level)
        turn ^= np.where((axes[-1] & bit) != 0, bit - one, 0).astype(np.uint64)
    key = np.zeros(len(points), np.uint64)
    for level in range(bits - 1, -1, -1):
        for axis in axes:
            key = (key << one) | (((axis ^ turn) >> np.uint64(level)) & one)
    return key.astype(np.int64)


def _directions(n_ids: int) -> np.ndarray:
    return np.random.default_rng(7).standard_normal((n_ids, DIMENSIONS)).astype(np.float32)


def tokenized(documents: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, curve_key, ids (little-endian 16- or 32-bit), wide: one row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if vocabulary not in _encoders:
            _encoders[vocabulary] = load_encoder(vocabulary), _directions(1 << 16)
        encode, directions = _encoders[vocabulary]
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                means, blobs, wide = np.zeros((part.num_rows, DIMENSIONS)), [], []
                for row, text in enumerate(part.column(1)):
                    ids = np.asarray([*encode(text.as_py() or ""), END_ID], np.uint32)
                    if len(ids) > 1:
                        means[row] = directions[ids[:-1] & 0xFFFF].mean(axis=0)
                    wide.append(bool(ids.max() > 0xFFFF))
                    blobs.append(ids.astype("<u4" if wide[-1] else "<u2").tobytes())
                # Means of many random directions are narrow around 0: squash to (0, 1) at that scale.
                unit = 0.5 + 0.5 * np.tanh(means * 4)
                points = np.minimum(unit * 2**BITS, 2**BITS - 1).astype(np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).cast(pa.int64()), pa.array(hilbert_key(points)), pa.array(blobs, pa.binary()), pa.array(wide)],
                    names=["doc_id", "curve_key", "ids", "wide"],
                )

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, curve_key long, ids binary, wide boolean")


def rest_lengths(rest: int) -> list[int]:
    """Powers of two that sum to ``rest``, largest first."""
    return [1 << bit for bit in range(rest.bit_length() - 1, -1, -1) if rest >> bit & 1]


def _pack(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Fill sequences of one partition in the order its rows come.

    The pieces of the sequence being filled are held back until it is full, as
    only then it is known not to be the last one.
    """
    sequence = TaskContext.get().partitionId() << 32
    held: list[tuple[int, int, np.ndarray, int, int]] = []  # doc_id, start, ids, doc_tokens, key
    filled = 0

    def rows(pieces, sequence_id):
        offset = 0
        for doc_id, start, ids, total, key in pieces:
            yield doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, sequence_id, offset, key
            offset += len(ids)

    def emit(found):
        columns = list(zip(*found, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[c.split()[0] for c in _PIECES.split(", ")])

    out: list[tuple] = []
    for batch in batches:
        for doc_id, key, blob, wide in zip(*(batch.column(i) for i in range(4)), strict=True):
            ids = np.frombuffer(blob.as_py(), "<u4" if wide.as_py() else "<u2")
            start, doc_id, key = 0, doc_id.as_py(), key.as_py()
            while start < len(ids):
                take = min(size - filled, len(ids) - start)
                held.append((doc_id, start, ids[start : start + take], len(ids), key))
                start, filled = start + take, filled + take
                if filled == size:
                    out.extend(rows(held, sequence))
                    held, filled, sequence = [], 0, sequence + 1
            if len(out) >= 10_000:
                yield emit(out)
                out = []
    for length in rest_lengths(filled):
        pieces, room = [], length
        while room:
            doc_id, start, ids, total, key = held.pop(0)
            pieces.append((doc_id, start, ids[:room], total, key))
            if len(ids) > room:
                held.insert(0, (doc_id, start + room, ids[room:], total, key))
            room -= min(room, len(ids))
        out.extend(rows(pieces, sequence))
        sequence += 1
    if out:
        yield emit(out)


def pack(documents: DataFrame, vocabulary: str | None = None, size: int = SEQUENCE) -> DataFrame:
    """Pieces of ``documents`` (doc_id, text) packed into sequences of ``size`` ids.

    One row per piece; the ids of a document are those of its text and the end
    id. A null or empty text is that one id. Repeated rows are packed each for
    itself, rows with a null doc_id too; other columns are ignored. No row in,
    no row out. ``size`` is a power of two.

    The ids are written once, as range bounds are sampled from them. Equal
    curve keys (copies) are spread by a hash of the id, so a large group of
    copies becomes several neighbouring ranges. There are as many ranges as the
    ids have times ``RANGE_BYTES``, so a task's share does not grow with the input.
    """
    rows = stage(tokenized(documents, vocabulary or default_vocabulary()), "tokens")
    spark = documents.sparkSession
    held = rows.agg(F.sum(F.length("ids"))).first()[0] or 0
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-held // RANGE_BYTES))
    spread = F.xxhash64("doc_id", F.crc32("ids"))
    ordered = (
        rows.withColumn("_spread", spread)
        .repartitionByRange(ranges, "curve_key", "_spread")
        .sortWithinPartitions("curve_key", "_spread", "doc_id")
        .select("doc_id", "curve_key", "ids", "wide")
    )
    return ordered.mapInArrow(lambda batches: _pack(batches, size), _PIECES)
