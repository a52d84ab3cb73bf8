"""Duplicate removal and one-row-per-key selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from granero.catalog import TableSpec


def drop_exact(df: DataFrame, copies: str | None = None) -> DataFrame:
    """One copy of each row; copies are combined before the shuffle. ``copies`` names a column for how many there were."""
    return df.dropDuplicates() if copies is None else df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(copies))


#: Words of repeated keys that are listed, few enough to go to every task; with more of them all rows are brought together.
MOST_WORDS = 10_000


def repeated_words(df: DataFrame, key: str) -> DataFrame:
    """_repetida: key / 64 of the keys that occur more than once (and of their neighbours); null if rows have no key.

    Whole-number keys only. What moves to find them is a bit per key, 64 of them in a row where they are numbered in
    a row and stand in one task; scattered keys take a row each.
    """
    keys = df.select(F.col(key).cast("bigint").alias("_clave"))
    bit = F.expr("shiftleft(1L, cast(_clave & 63 as int))")
    words = keys.groupBy(F.shiftright("_clave", 6).alias("_repetida")).agg(
        F.count(F.lit(1)).alias("_filas"), F.coalesce(F.bit_count(F.bit_or(bit)), F.lit(0)).alias("_claves")
    )
    return words.where("_filas > _claves").select("_repetida")


def drop_exact_among(df: DataFrame, key: str, words: DataFrame, copies: str) -> DataFrame:
    """As :func:`drop_exact`, where only rows whose key lies in one of ``words`` can have copies: the others stay where they are."""
    listed = F.shiftright(F.col(key).cast("bigint"), 6).eqNullSafe(F.col("_repetida"))
    alone = df.join(words, listed, "left_anti").withColumn(copies, F.lit(1).cast("bigint"))
    return alone.unionByName(drop_exact(df.join(words, listed, "left_semi"), copies))


def first_per_key(
    df: DataFrame, key: Sequence[str], order: Sequence[Column | str], unique: bool = False
) -> DataFrame:
    """The first row of each key in the given order.

    Rows that tie on ``order`` are told apart by a hash of the whole row, so the
    choice does not depend on how the data is laid out. ``unique`` states that
    nothing ties, or that rows that tie are alike to the reader; the hash, and
    with it the reading of all columns, is then left out. Spark limits every key
    to its best row within each task before the shuffle, so a key that holds a
    large part of the table sends one row per task.
    """
    ties = [] if unique else [F.xxhash64(*df.columns)]
    ranking = Window.partitionBy(*key).orderBy(*order, *ties)
    return df.withColumn("_orden", F.row_number().over(ranking)).where("_orden = 1").drop("_orden")


def first_and_count(df: DataFrame, key: Sequence[str], order: Sequence[str], copies: str) -> DataFrame:
    """The row that :func:`first_per_key` keeps (smallest ``order``, nulls first), and how many rows its key has.

    A minimum and a count, so a key that holds a large part of the table sends
    one row per task here too.
    """
    rest = [c for c in df.columns if c not in key and c not in order]
    whole = F.struct(*order, F.xxhash64(*df.columns).alias("_mezcla"), *rest)
    best = df.groupBy(*key).agg(F.min(whole).alias("_fila"), F.count(F.lit(1)).alias(copies))
    return best.select(*[F.col(c) if c in key else F.col(f"_fila.{c}") for c in df.columns], copies)


def deduplicate(
    df: DataFrame, spec: TableSpec, keyed: bool = False, copies: str | None = None, repeated: DataFrame | None = None
) -> DataFrame:
    """Exact duplicates removed and, where declared, repeated business keys.

    Copies of a row share its business key, so the second step alone covers
    both and costs one shuffle instead of two. The smallest primary key stays.
    With ``keyed`` the table comes out of a keyed load: its primary key is
    unique, no two rows can be equal, and the exact step is left out. ``copies``
    names a column that says how many rows each kept row stands for, so that
    nobody has to count the input again. ``repeated`` are the :func:`repeated_words`
    of the primary key, if they were looked for before.
    """
    if spec.business_key:
        if copies is not None:
            return first_and_count(df, spec.business_key, [spec.key], copies)
        return first_per_key(df, spec.business_key, [F.col(spec.key).asc_nulls_first()], unique=keyed)
    if repeated is not None and copies is not None and not keyed:
        return drop_exact_among(df, spec.key, repeated, copies)
    if spec.gathered_by and not keyed:  # copies share it; combining them before rows move would only spill
        df = df.repartition(spec.gathered_by)
    if keyed:
        return df if copies is None else df.withColumn(copies, F.lit(1).cast("bigint"))
    return drop_exact(df, copies)
