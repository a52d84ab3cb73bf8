"""Benchmark decontamination by winnowed fingerprints.

A window is ``WINDOW`` consecutive words of a benchmark item, or the whole item
if it is shorter. For windows of n words both sides keep, of every n - k + 1
neighbouring k-grams, the smallest hash (k about n / 2). Equal windows keep
equal fingerprints, so every shared span of n words yields a common one. Common
fingerprints are joined, and each hit is extended word by word to the left and
right; spans that reach n words are contaminated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granero.llm import text as tx
from granero.session import stage

WINDOW = 13
#: Up to so many benchmark fingerprints (8 bytes each) filter documents inside the scan; more of them are joined with all fingerprints of the documents.
IN_SCAN = 1 << 20
ITEMS_AT_ONCE = 256


def gram_size(window: int) -> int:
    return window - window // 2


def winnow(grams: np.ndarray, width: int) -> np.ndarray:
    """Positions of grams that are the smallest of some ``width`` neighbours (of all of them, if there are fewer)."""
    width = min(width, len(grams))
    if width <= 1:
        return np.arange(len(grams))
    lowest, reach = grams, 1
    while reach < width:  # minimum of the next `reach` grams
        step = min(reach, width - reach)
        lowest, reach = np.minimum(lowest[:-step], lowest[step:]), reach + step
    padded = np.concatenate([np.zeros(width - 1, np.uint64), lowest, np.zeros(width - 1, np.uint64)])
    highest, reach = padded, 1
    while reach < width:
        step = min(reach, width - reach)
        highest, reach = np.maximum(highest[:-step], highest[step:]), reach + step
    return np.flatnonzero(grams <= highest)


def fingerprints(words: tx.Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Word positions and hashes of the fingerprints of a run of documents for windows of ``window`` words.

    Grams across documents never stand in a document's own window; they only
    add a few positions, which later checks refuse.
    """
    k = gram_size(window)
    grams = words.grams(k)
    kept = winnow(grams, window - k + 1)
    return kept, grams[kept]


def _hit_spans(document: np.ndarray, prints: dict, item: np.ndarray) -> np.ndarray:
    """Word spans (start, end) of one document that occur in one item, from common fingerprints extended."""
    window = min(WINDOW, len(item))
    k = gram_size(window)
    grams = tx.Words(None, None, item, np.array([0, len(item)])).grams(k)
    kept = winnow(grams, window - k + 1)
    if window not in prints:
        whole = tx.Words(None, None, document, np.array([0, len(document)]))
        at, values = fingerprints(whole, window)
        order = np.argsort(values, kind="stable")
        prints[window] = at[order], values[order]
    at, values = prints[window]
    spans = []
    for start, value in zip(kept.tolist(), grams[kept], strict=True):
        places = at[np.searchsorted(values, value) : np.searchsorted(values, value, "right")]
        if not len(places):
            continue
        left, right = np.zeros(len(places), np.int64), np.zeros(len(places), np.int64)
        going = np.ones(len(places), bool)
        for step in range(1, min(window - k, start) + 1):
            there = places - step
            going = going & (there >= 0) & (document[there] == item[start - step])
            left += going
        going = np.ones(len(places), bool)
        for step in range(min(window - k, len(item) - start - k)):
            there = places + k + step
            going = going & (there < len(document)) & (document[np.minimum(there, len(document) - 1)] == item[start + k + step])
            right += going
        long_enough = left + k + right >= window
        spans.append(np.stack([places - left, places + k + right], 1)[long_enough])
    return np.concatenate(spans) if spans else np.zeros((0, 2), np.int64)


def merged(spans: np.ndarray) -> np.ndarray:
    """Sorted spans without overlaps."""
    if not len(spans):
        return spans
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    ends = np.maximum.accumulate(spans[:, 1])
    first = np.concatenate([[True], spans[1:, 0] > ends[:-1]])
    last = np.concatenate([first[1:], [True]])
    return np.stack([spans[first, 0], ends[last]], 1)


def _index(items: DataFrame) -> DataFrame:
    """item_key, window, print: distinct fingerprints of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            for low, high, data, offsets in tx.slices(batch.column(1)):
                words = tx.words_of(data, offsets, tx.ALPHANUMERIC)
                for row in range(low, high):
                    a, b = words.first[row - low], words.first[row - low + 1]
                    if a == b:
                        continue
                    own = tx.Words(None, None, words.hashes[a:b], np.array([0, b - a]))
                    window = min(WINDOW, b - a)
                    values = np.unique(fingerprints(own, int(window))[1]).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(values), keys[row])), pa.array(np.full(len(values), window, np.int32)), pa.array(values)],
                        names=["item_key", "window", "print"],
                    )

    return items.select("item_key", "text").mapInArrow(run, "item_key long, window int, print long")


def _scanned(documents: DataFrame, windows: list[int], known: np.ndarray | None) -> DataFrame:
    """doc_id, text_hash, n_words, prints, text: all fingerprints of each document, or those in ``known``.

    The text is kept where fingerprints are left, as only those rows are looked at again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(2)
            for low, high, data, offsets in tx.slices(column):
                words = tx.words_of(data, offsets, tx.ALPHANUMERIC)
                rows = high - low
                owners, values = [], []
                for window in windows:
                    at, prints = fingerprints(words, window)
                    if known is not None and len(known):
                        place = np.minimum(np.searchsorted(known, prints), len(known) - 1)
                        hit = known[place] == prints
                        at, prints = at[hit], prints[hit]
                    elif known is not None:
                        at, prints = at[:0], prints[:0]
                    owners.append(np.searchsorted(words.first, at, "right") - 1)
                    values.append(prints)
                owner = np.concatenate(owners) if owners else np.zeros(0, np.int64)
                value = np.concatenate(values) if values else np.zeros(0, np.uint64)
                order = np.argsort(owner, kind="stable")
                counts = np.bincount(owner, minlength=rows)
                part = batch.slice(low, rows)
                text = part.column(2)
                kept = text.take(pa.array(np.arange(rows), mask=counts == 0))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array(np.diff(words.first), pa.int64()),
                        tx.list_array(pa.array(value[order].view(np.int64)), counts),
                        kept,
                    ],
                    names=["doc_id", "text_hash", "n_words", "prints", "text"],
                )

    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text"
    ).mapInArrow(run, "doc_id long, text_hash long, n_words long, prints array<long>, text string")


def _extended(suspects: DataFrame) -> DataFrame:
    """doc_id, text_hash, spans, item_keys from rows with a text and the candidate items' keys and texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                data, offsets = tx.buffers(batch.column(2).slice(row, 1))
                document = tx.words_of(data, offsets, tx.ALPHANUMERIC).hashes
                candidates = batch.column(3)[row].as_py()
                data, offsets = tx.buffers(pa.array([c["text"] for c in candidates], pa.large_string()))
                words = tx.words_of(data, offsets, tx.ALPHANUMERIC)
                prints: dict = {}
                spans, hit = [], []
                for i, candidate in enumerate(candidates):
                    found = _hit_spans(document, prints, words.hashes[words.first[i] : words.first[i + 1]])
                    if len(found):
                        spans.append(found)
                        hit.append(candidate["item_key"])
                if not hit:
                    continue
                joined = merged(np.concatenate(spans))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, 1),
                        batch.column(1).slice(row, 1),
                        pa.array([[{"low": a, "high": b} for a, b in joined.tolist()]], pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))),
                        pa.array([hit], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "text_hash", "spans", "item_keys"],
                )

    return suspects.mapInArrow(
        run, "doc_id long, text_hash long, spans array<struct<low:long,high:long>>, item_keys array<long>"
    )


def _covered(spans: Column) -> Column:
    """Length of the union of spans sorted by their start."""
    state = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("total"))
    return F.aggregate(
        spans,
        state,
        lambda acc, s: F.struct(
            F.greatest(acc["end"], s["high"]).alias("end"),
            (acc["total"] + F.greatest(s["high"] - F.greatest(s["low"], acc["end"]), F.lit(0))).alias("total"),
        ),
        lambda acc: acc["total"],
    )


def contamination(documents: DataFrame, benchmark: DataFrame, in_scan: int = IN_SCAN) -> DataFrame:
    """One row per document: doc_id, text_hash, n_words, n_hit, item_ids (sorted), contaminated.

    ``documents`` has doc_id and text, ``benchmark`` item_id and text; other
    columns are ignored. Null and empty texts have no words and are clean; an
    item without words is never found. Rows with the same doc_id and text get
    equal results; an item id with several texts occurs if one of them does; an
    item without id marks words but is not listed. With no items nothing is hit.

    The benchmark is broadcast only while it has up to ``in_scan``
    fingerprints; beyond that all fingerprints are joined by shuffle.
    """
    items = stage(
        benchmark.select("item_id", "text")
        .where("text IS NOT NULL")
        .distinct()
        .withColumn("item_key", F.xxhash64("item_id", "text", F.lit(1))),
        "items",
    )
    index = stage(_index(items), "index")
    windows = sorted(r[0] for r in index.select("window").distinct().collect())  # WINDOW at most
    prints = index.select("print").distinct()
    known = None
    if prints.count() <= in_scan:
        known = np.sort(np.array([r[0] for r in prints.collect()], np.int64).view(np.uint64))
    scanned = stage(_scanned(documents, windows, known), "scanned")

    keys = ["doc_id", "text_hash"]
    hits = scanned.where(F.size("prints") > 0)
    pairs = (
        hits.select(*keys, F.explode(F.array_distinct("prints")).alias("print"))
        .join(index.select("print", "item_key"), "print")
        .select(*keys, "item_key")
        .distinct()
    )
    told = pairs.join(items.select("item_key", F.col("text").alias("item_text")), "item_key")
    chunk = F.pmod(F.col("item_key"), F.ceil(F.col("n_items") / ITEMS_AT_ONCE))
    counted = pairs.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_items"))
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["text_hash"] == b["text_hash"])
    grouped = (
        told.join(counted, same(told, counted))
        .select(told["doc_id"], told["text_hash"], chunk.alias("chunk"), "item_key", "item_text")
        .groupBy(*keys, "chunk")
        .agg(F.collect_list(F.struct("item_key", F.col("item_text").alias("text"))).alias("candidates"))
    )
    suspects = hits.select(*keys, "text").dropDuplicates(keys)
    rows = suspects.join(grouped, same(suspects, grouped)).select(
        suspects["doc_id"], suspects["text_hash"], "text", "candidates"
    )
    found = stage(_extended(rows), "spans")
    spans = found.groupBy(*keys).agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))
    listed = (
        found.select(*keys, F.explode("item_keys").alias("item_key"))
        .join(items.select("item_key", "item_id"), "item_key")
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"))
    )
    hit = spans.join(listed, same(spans, listed)).select(
        spans["doc_id"].alias("hit_id"), spans["text_hash"].alias("hit_hash"), _covered(F.col("spans")).alias("hit_words"), "item_ids"
    )
    joined = scanned.select(*keys, "n_words").join(
        hit, F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash")), "left"
    )
    n_hit = F.coalesce("hit_words", F.lit(0).cast("long"))
    return joined.select(
        *keys,
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def decontaminate(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``documents`` without the contaminated ones; columns stay as they are."""
    report = contamination(documents, benchmark).where("contaminated")
    bad = report.select(F.col("doc_id").alias("__bad_id"), F.col("text_hash").alias("__bad_hash")).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("__bad_id")) & (F.xxhash64("text") == F.col("__bad_hash"))
    return documents.join(bad, same, "left_anti")
