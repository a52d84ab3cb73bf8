"""Vectorised helpers for whole texts inside tasks: words, hashes, documents of an Arrow batch.

Everything here works on the UTF-8 bytes of an Arrow string column, so a batch
is never turned into Python strings. A batch is cut into slices of about
``SLICE`` bytes and hashed in blocks of that size, which bounds the memory of a
task by a few slices plus the words of the longest single document.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE = 1 << 20
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_random = np.random.default_rng(20240229)
_BYTE_VALUE = _random.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_UPPER = np.arange(256)
_UPPER[65:91] += 32
_FOLDED_VALUE = _BYTE_VALUE[_UPPER]


def byte_class(excluded: list[tuple[int, int]]) -> np.ndarray:
    """Which bytes belong to a word: all but the given inclusive ranges.

    Ranges are ASCII, so a class of code points and its bytes agree in UTF-8.
    """
    inside = np.ones(256, bool)
    for low, high in excluded:
        inside[low : high + 1] = False
    return inside


#: Words are runs without blanks.
NOT_BLANK = byte_class([(0x20, 0x20), (0x09, 0x0D)])
#: Words are runs of ASCII letters and digits and of everything beyond ASCII.
ALPHANUMERIC = byte_class([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])
ALPHANUMERIC[65:91] = True  # upper-case letters are folded first


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (finaliser of splitmix64)."""
    values = (values ^ (values >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> _U(27))) * _U(0x94D049BB133111EB)
    return values ^ (values >> _U(31))


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


_tables: list[tuple[np.ndarray, np.ndarray]] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, ``n`` at least; one pair of tables serves all blocks of usual size."""
    usual = SLICE + (1 << 13)
    if n > usual:
        return _powers(_BASE, n), _powers(pow(_BASE, -1, 2**64), n)
    if not _tables or len(_tables[0][0]) < usual:
        _tables[:] = [(_powers(_BASE, usual), _powers(pow(_BASE, -1, 2**64), usual))]
    return _tables[0]


@dataclass
class Words:
    """Words of a run of documents: byte spans, 64-bit hashes, first word of each document, hashes of their first bytes."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray  # one entry more than there are documents
    stems: np.ndarray | None = None

    def grams(self, k: int) -> np.ndarray:
        """Hash of the k words from each position; positions whose k words cross a document's end are garbage."""
        n = len(self.hashes) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        out = self.hashes[:n].copy()
        for j in range(1, k):
            out *= _U(0xD6E8FEB86659FD93)
            out += self.hashes[j : j + n]
        return mix(out + _U(k))


def words_of(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, stems_of: tuple[int, ...] = ()) -> Words:
    """Words of the documents ``data[offsets[i]:offsets[i + 1]]``; A-Z count as a-z in the hashes.

    ``stems_of`` lists lengths: the first so many bytes of each word are hashed
    too, in one column per length.
    """
    starts, ends, hashes, stems = [], [], [], []
    low, end = int(offsets[0]), int(offsets[-1])
    while low < end:
        high = min(low + SLICE, end)
        while high < end:  # move the cut behind the word it falls into
            tail = inside[data[high : high + 4096]]
            stop = int(np.argmin(tail)) if not tail.all() else len(tail)
            bound = int(offsets[np.searchsorted(offsets, high)])
            high = min(high + stop, bound)
            if stop < len(tail) or high == bound:
                break
        block = data[low:high]
        word = inside[block]
        before = np.empty(len(word), bool)
        before[0] = False
        before[1:] = word[:-1]
        after = np.empty(len(word), bool)
        after[-1] = False
        after[:-1] = word[1:]
        cuts = offsets[np.searchsorted(offsets, low) : np.searchsorted(offsets, high, "right")] - low
        before[cuts[cuts < len(word)]] = False
        after[cuts[cuts > 0] - 1] = False
        s = np.flatnonzero(word & ~before)
        e = np.flatnonzero(word & ~after) + 1
        up, down = _power_tables(len(block) + 1)
        prefix = np.empty(len(block) + 1, np.uint64)
        prefix[0] = 0
        np.cumsum(_FOLDED_VALUE[block] * up[: len(block)], dtype=np.uint64, out=prefix[1:])
        hashes.append(mix((prefix[e] - prefix[s]) * down[s]))
        cuts = [np.minimum(e, s + size) for size in stems_of]
        if cuts:
            stems.append(np.stack([mix((prefix[c] - prefix[s]) * down[s] + _U(0x5851F42D4C957F2D)) for c in cuts], 1))
        starts.append(s + low)
        ends.append(e + low)
        low = high
    joined = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    return Words(
        joined,
        np.concatenate(ends) if ends else np.zeros(0, np.int64),
        np.concatenate(hashes) if hashes else np.zeros(0, np.uint64),
        np.searchsorted(joined, offsets),
        np.concatenate(stems) if stems else np.zeros((0, len(stems_of)), np.uint64),
    )


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data and data.size else np.zeros(0, np.uint8), offsets


def slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of about ``SLICE`` bytes, one row at least: first row, end row, bytes, offsets of the run."""
    data, offsets = buffers(column)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + SLICE, "right")) - 1
        end = min(max(end, row + 1), len(column))
        yield row, end, data, offsets[row : end + 1]
        row = end


def ragged(lows: np.ndarray, highs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All integers of the ranges [low, high), and the range each belongs to."""
    sizes = np.maximum(highs - lows, 0)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    first = np.cumsum(sizes) - sizes
    return np.arange(len(owner)) - np.repeat(first, sizes) + lows[owner], owner


def list_array(values: pa.Array, sizes: np.ndarray) -> pa.ListArray:
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)
