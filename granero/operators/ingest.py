"""Incremental load: audit stamps, watermarks, keyed upsert."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from granero.catalog import TableSpec

INGEST_PARTITIONS = ["_anio_ingesta", "_mes_ingesta", "_dia_ingesta"]
AUDIT_COLUMNS = ["_ts_ingesta", "_sistema_fuente", "_batch_id", *INGEST_PARTITIONS]
#: Which row of a key is valid: that of the latest run.
NEWEST = ("_ts_ingesta", "_batch_id")


def stamp(df: DataFrame, run_ts: str | dt.datetime, system: str, batch_id: str) -> DataFrame:
    """Add the six audit columns of one run."""
    ts = F.lit(run_ts).cast("timestamp")
    return df.select(
        "*",
        ts.alias("_ts_ingesta"),
        F.lit(system).alias("_sistema_fuente"),
        F.lit(batch_id).alias("_batch_id"),
        F.year(ts).alias("_anio_ingesta"),
        F.month(ts).alias("_mes_ingesta"),
        F.dayofmonth(ts).alias("_dia_ingesta"),
    )


def drop_audit(df: DataFrame) -> DataFrame:
    return df.drop(*AUDIT_COLUMNS)


def watermark(loaded: DataFrame, col: str, as_of: dt.date | None = None) -> DataFrame:
    """One row with the latest loaded date.

    With ``as_of`` later dates are ignored: a single row dated in the future
    would otherwise stop every following incremental load.
    """
    day = F.col(col) if as_of is None else F.when(F.col(col) <= F.lit(as_of), F.col(col))
    return loaded.agg(F.max(day).alias("watermark"))


def _mark(loaded: DataFrame, spec: TableSpec, as_of: dt.date | None) -> dt.date | None:
    """The watermark as a value, so that the filter on the source is pushed into its scan."""
    return watermark(loaded, spec.watermark, as_of).first()["watermark"]


def after(source: DataFrame, col: str, mark: dt.date | None) -> DataFrame:
    """Rows dated strictly after the watermark; all rows while there is none."""
    return source if mark is None else source.where(F.col(col) > F.lit(mark))


def increment(
    source: DataFrame,
    loaded: DataFrame | None,
    spec: TableSpec,
    incremental: bool = True,
    as_of: dt.date | None = None,
) -> DataFrame:
    """What a run has to load: everything, or what is newer than the loaded rows."""
    if not incremental or loaded is None or spec.watermark is None:
        return source
    return after(source, spec.watermark, _mark(loaded, spec, as_of))


def late(source: DataFrame, loaded: DataFrame, spec: TableSpec, as_of: dt.date | None = None) -> DataFrame:
    """Rows an incremental run skips for good: not after the watermark and not loaded."""
    mark = F.lit(_mark(loaded, spec, as_of)).cast("date")
    known = source.where(F.col(spec.key).isNotNull())
    return known.where(F.col(spec.watermark) <= mark).join(loaded.select(spec.key), spec.key, "left_anti")


def day_prints(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Per day of the watermark column how many keys there are and what their hashes add up to.

    Days with equal keys have equal prints; two different sets of keys have them
    by chance once in 2 ** 62 times. Rows without a date are left out, a day
    whose rows have no key counts none.
    """
    half = F.lit(0x7FFFFFFF)
    name = F.when(F.col(spec.key).isNotNull(), F.xxhash64(spec.key))
    dated = rows.where(F.col(spec.watermark).isNotNull()).select(F.col(spec.watermark).alias("dia"), name.alias("_h"))
    return dated.groupBy("dia").agg(
        F.count("_h").alias("filas"),
        F.coalesce(F.sum(F.col("_h").bitwiseAND(half)), F.lit(0)).alias("suma_a"),
        F.coalesce(F.sum(F.shiftright("_h", 31).bitwiseAND(half)), F.lit(0)).alias("suma_b"),
    )


def joined_prints(prints: DataFrame) -> DataFrame:
    """Prints of several batches as those of one table."""
    return prints.groupBy("dia").agg(*[F.sum(c).alias(c) for c in ("filas", "suma_a", "suma_b")])


def mark_of(prints: DataFrame, as_of: dt.date | None = None) -> dt.date | None:
    """The watermark, from the days that were loaded and without a look at the table."""
    return watermark(prints, "dia", as_of).first()["watermark"]


def late_by_day(
    source: DataFrame, loaded: DataFrame, prints: DataFrame, spec: TableSpec, mark: dt.date, days: int = 4000
) -> DataFrame | None:
    """The rows of :func:`late`, looked for in the days whose keys are not those that were loaded.

    ``prints`` are those of the loaded rows. The source is read once for its own
    (key and date, one row per day moves); when no day differs there is nothing
    to join and the result is None. Of the other days the rows are compared with
    what was loaded for these days; only what is left then (a late row, or one
    whose date has changed) is looked for in the whole table, which is read for
    its keys and not moved. A key that was loaded twice only makes its day differ.
    """
    known = source.where(F.col(spec.key).isNotNull() & (F.col(spec.watermark) <= F.lit(mark)))
    sums = ["filas", "suma_a", "suma_b"]
    before = joined_prints(prints).select("dia", *[F.col(c).alias(f"_{c}") for c in sums])
    same = F.lit(True)
    for c in sums:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    found = day_prints(known, spec).join(before, "dia", "left").where(~same).select("dia")
    differing = [r["dia"] for r in found.orderBy("dia").limit(days + 1).collect()]
    if not differing:
        return None
    day = F.col(spec.watermark)
    if len(differing) > days:  # more than a filter should list: the range that they span
        there = (day >= F.lit(differing[0])) & (day <= F.lit(mark))
    else:
        there = day.between(F.lit(differing[0]), F.lit(differing[-1])) & day.isin(*differing)
    left = known.where(there).join(loaded.where(there).select(spec.key), spec.key, "left_anti")
    keys = left.select(spec.key).distinct()
    elsewhere = loaded.join(keys, spec.key, "left_semi").select(spec.key)
    return left.join(elsewhere, spec.key, "left_anti")


def upsert(target: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Target rows replaced by changes with the same key, plus the new ones.

    ``changes`` must hold each key once and no null key (see
    :func:`check_upsert_keys`). It is the side that moves when it is small;
    the target then stays where it is.
    """
    untouched = target.join(changes.select(key), key, "left_anti")
    return untouched.select(*target.columns).unionByName(changes)


def _first_rank(rows: DataFrame, by: Sequence[str], *partition: Column | str) -> DataFrame:
    ranking = Window.partitionBy(*partition).orderBy(*[F.col(c).desc_nulls_last() for c in by])
    return rows.withColumn("_orden", F.rank().over(ranking)).where("_orden = 1").drop("_orden")


def keys_in_both(rows: DataFrame, settled: DataFrame, key: str) -> DataFrame:
    """The keys of ``rows`` that stand in ``settled`` too, each once; of both nothing but the keys moves."""
    known, arrived = (df.select(key).where(F.col(key).isNotNull()) for df in (settled, rows))
    return known.join(arrived, key, "left_semi").distinct()


def newest(
    rows: DataFrame, key: str, by: Sequence[str] = NEWEST, settled: DataFrame | None = None, keys: DataFrame | None = None
) -> DataFrame:
    """Of a table made of batches the valid rows: per key those with the largest ``by``.

    Rows of a key that tie all stay, so copies within a batch are still there to
    be counted. Rows without a key replace nothing but an equal row of an
    earlier batch; they are a branch of their own, so that the others are ranked
    by key and ``by`` alone and whoever asks for two columns reads no more. Each
    task keeps only its first rows per key before the shuffle, so a hot key
    moves little.

    ``settled`` holds rows that were brought down to the valid ones before. Of
    these only the rows whose key occurs in ``rows`` are ranked again: the
    others stay where they are, and what moves follows ``rows``. That holds as
    long as the keys of ``rows`` can be broadcast; ``keys`` are those of them that
    :func:`keys_in_both` has found and that were written before, mostly few: their
    size is known when the join is planned.
    """
    audit = set(AUDIT_COLUMNS)
    same = F.xxhash64(*[c for c in rows.columns if c not in audit])
    with_key, without = F.col(key).isNotNull(), F.col(key).isNull()
    keyed, lost = rows.where(with_key), rows.where(without)
    if settled is None:
        return _first_rank(keyed, by, key).unionByName(_first_rank(lost, by, same))
    settled = settled.select(*rows.columns)
    keys = keyed.select(key).distinct() if keys is None else keys
    again = keyed.unionByName(settled.where(with_key).join(keys, key, "left_semi").select(*rows.columns))
    still = settled.where(with_key).join(keys, key, "left_anti").select(*rows.columns)
    lost = _first_rank(lost.unionByName(settled.where(without)), by, same)
    return still.unionByName(_first_rank(again, by, key)).unionByName(lost)


def check_upsert_keys(changes: DataFrame, key: str) -> tuple | None:
    """Smallest and largest key of the changes; None without rows.

    Fails when a key is null or repeated, as a keyed merge would. Keys are
    counted where they are before they move, and one row comes back.
    """
    per_key = changes.groupBy(key).agg(F.count("*").alias("n"))
    found = per_key.agg(
        F.min(key).alias("lo"),
        F.max(key).alias("hi"),
        F.count_if(F.col("n") > 1).alias("repeated"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).alias("null_keys"),
    ).first()
    if found["repeated"] or found["null_keys"]:
        raise ValueError(f"cannot upsert: {found['repeated']} repeated and {found['null_keys']} null value(s) of {key}")
    return None if found["lo"] is None else (found["lo"], found["hi"])
