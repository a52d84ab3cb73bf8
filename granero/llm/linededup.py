"""Removal of repeated passages by overlapping windows of three lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 3


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _starts(lines: Column, width: int) -> Column:
    """Start positions of the windows of a text; a text with fewer lines has one window."""
    return F.sequence(F.lit(0), F.greatest(F.size(lines) - width, F.lit(0)))


def _window_text(lines: Column, start: Column, width: int) -> Column:
    return F.array_join(F.slice(lines, start + 1, width), "\n")


def windows(documents: DataFrame, width: int = WINDOW) -> DataFrame:
    """doc_id, _text_hash, start, h1, h2: a row for each window that is not blank throughout."""
    lines = documents.select("doc_id", F.xxhash64("text").alias("_text_hash"), _lines(F.col("text")).alias("_lines"))
    each = F.transform(
        _starts(F.col("_lines"), width),
        lambda start: F.struct(
            start.alias("start"),
            F.xxhash64(_window_text(F.col("_lines"), start, width)).alias("h1"),
            F.xxhash64(F.lit(1), _window_text(F.col("_lines"), start, width)).alias("h2"),
            F.trim(_window_text(F.col("_lines"), start, width)).rlike(r"\S").alias("filled"),
        ),
    )
    return (
        lines.select("doc_id", "_text_hash", F.inline(each))
        .where("filled")
        .drop("filled")
    )


def repeated_starts(documents: DataFrame, width: int = WINDOW) -> DataFrame:
    """doc_id, _text_hash, _starts: start positions of windows that occurred before, per document.

    The first occurrence of a window is the one with the smallest (doc_id, text
    hash, position). Windows are counted per task before the shuffle; only
    those that repeat meet their occurrences again, in a join whose hot keys
    Spark splits at run time.
    """
    found = windows(documents, width)
    place = F.struct("doc_id", "_text_hash", "start")
    first = (
        found.groupBy("h1", "h2")
        .agg(F.min(place).alias("_first"), F.max(place).alias("_last"))
        .where("_first < _last")
        .select("h1", "h2", "_first")
    )
    return (
        found.join(first, ["h1", "h2"])
        .where(F.col("_first") < place)
        .groupBy("doc_id", "_text_hash")
        .agg(F.collect_set("start").alias("__dedup_starts"))
    )


def dedup_lines(documents: DataFrame, width: int = WINDOW) -> DataFrame:
    """``documents`` without passages that stand in an earlier document or earlier in the same one.

    ``text`` loses every line that a later occurrence of a repeated window
    covers; ``n_lines`` and ``n_removed`` are added (in place of columns that are
    called so), other columns stay as they are. Documents are ordered by (doc_id, hash of the text), null ids first; rows
    with the same doc_id and text are one document listed twice and are cut
    alike. A text of fewer than ``width`` lines is one window. Windows of blank
    lines are never repeats. A text that loses all lines becomes empty; a null
    text stays null with no lines. No row is dropped.
    """
    starts = repeated_starts(documents.select("doc_id", "text"), width)
    starts = starts.select(F.col("doc_id").alias("__dedup_id"), F.col("_text_hash").alias("__dedup_hash"), "__dedup_starts")
    joined = documents.join(
        starts,
        F.col("doc_id").eqNullSafe(F.col("__dedup_id")) & (F.xxhash64("text") == F.col("__dedup_hash")),
        "left",
    )
    every = F.col("__dedup_all")
    covered = F.flatten(
        F.transform("__dedup_starts", lambda s: F.sequence(s, F.least(s + width, F.size(every)) - 1))
    )
    untouched = F.col("__dedup_kept").isNull()
    kept_lines = F.transform("__dedup_kept", lambda i: F.element_at(every, i + 1))
    clean = F.when(untouched, F.col("text")).otherwise(F.array_join(kept_lines, "\n"))
    removed = F.when(untouched, 0).otherwise(F.size(every) - F.size("__dedup_kept"))
    others = [F.col(c) for c in documents.columns if c not in ("text", "n_lines", "n_removed")]
    return (
        joined.withColumn("__dedup_all", _lines(F.col("text")))
        .withColumn("__dedup_kept", F.array_except(F.sequence(F.lit(0), F.size(every) - 1), covered))
        .select(
            *others,
            clean.alias("text"),
            F.when(F.col("text").isNull(), 0).otherwise(F.size(every)).cast("long").alias("n_lines"),
            removed.cast("long").alias("n_removed"),
        )
    )
