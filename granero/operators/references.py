"""Lookups and referential checks between tables."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def left_lookup(fact: DataFrame, dim: DataFrame, key: str, spread_nulls_by: str | None = None) -> DataFrame:
    """Left join on ``key``; fact rows without a match keep null attributes.

    No side is hinted: Spark broadcasts the dimension when its size allows, and
    otherwise shuffles both, splitting hot keys on the fact side at run time.
    With ``spread_nulls_by`` (a column with many values) rows whose key is null
    are scattered over all tasks instead of meeting in one.
    """
    if spread_nulls_by is None:
        return fact.join(dim, key, "left")
    scattered = -F.pmod(F.xxhash64(spread_nulls_by), F.lit(1 << 20)) - 1
    probe = fact.withColumn("_clave", F.coalesce(F.col(key).cast("bigint"), scattered))
    build = dim.withColumn("_clave_dim", F.col(key).cast("bigint")).drop(key)
    matches = (F.col("_clave") == F.col("_clave_dim")) & F.col(key).isNotNull()
    return probe.join(build, matches, "left").select(*fact.columns, *[c for c in dim.columns if c != key])


def _keys(parent: DataFrame, key: str, name: str) -> DataFrame:
    return parent.select(F.col(key).alias(name)).where(F.col(name).isNotNull()).distinct()


@dataclass(frozen=True)
class PackedKeys:
    """Whole-number keys of a parent as (_palabra, _bits): bit b of word w stands for key 64 w + b."""

    words: DataFrame


def packed_keys(parent: DataFrame, key: str) -> PackedKeys:
    """The keys, 64 of them in a row where they are numbered in a row; scattered ones take a row each."""
    keys = parent.select(F.col(key).cast("bigint").alias("_clave")).where(F.col("_clave").isNotNull())
    bit = F.expr("shiftleft(1L, cast(_clave & 63 as int))")
    return PackedKeys(keys.groupBy(F.shiftright("_clave", 6).alias("_palabra")).agg(F.bit_or(bit).alias("_bits")))


def _with_packed_flag(child: DataFrame, fk: str, parent: PackedKeys, flag: str, spread_nulls_by: str | None) -> DataFrame:
    probe = child.withColumn("_palabra", F.shiftright(F.col(fk).cast("bigint"), 6))
    place = F.col(fk).cast("bigint").bitwiseAND(F.lit(63)).cast("int")
    hit = F.coalesce(F.getbit("_bits", place) == 1, F.lit(False)).alias(flag)
    columns = child.columns if spread_nulls_by else [fk, *[c for c in child.columns if c != fk]]  # as a join by name has them
    return left_lookup(probe, parent.words, "_palabra", spread_nulls_by).select(*columns, hit)


def with_match_flag(
    child: DataFrame, fk: str, parent: DataFrame | PackedKeys, key: str, flag: str, spread_nulls_by: str | None = None
) -> DataFrame:
    """Add ``flag``: does the foreign key exist in the parent? A null key does not.

    A left join rather than a semi plus an anti join: one pass yields both sides
    of the split, and a hot foreign key can be split between tasks. With
    ``spread_nulls_by`` null keys are scattered as in :func:`left_lookup`. The
    parent may be given as its packed keys: Spark then broadcasts those of a
    table 64 times as large, and the child stays where it is.
    """
    if isinstance(parent, PackedKeys):
        return _with_packed_flag(child, fk, parent, flag, spread_nulls_by)
    keys = _keys(parent, key, fk).withColumn("_hit", F.lit(True))
    return left_lookup(child, keys, fk, spread_nulls_by).withColumn(flag, F.coalesce("_hit", F.lit(False))).drop("_hit")


def orphans(child: DataFrame, fk: str, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose foreign key is null or has no parent."""
    return child.join(_keys(parent, key, "_pk"), F.col(fk) == F.col("_pk"), "left_anti")


def resolved(child: DataFrame, fk: str, parent: DataFrame, key: str) -> DataFrame:
    """Rows whose foreign key has a parent."""
    return child.join(_keys(parent, key, "_pk"), F.col(fk) == F.col("_pk"), "left_semi")


def resolved_or_null(
    child: DataFrame, fk: str, parent: DataFrame, key: str, spread_nulls_by: str | None = None
) -> DataFrame:
    """As :func:`resolved`, but a null foreign key passes as well (one pass, no re-union)."""
    flagged = with_match_flag(child, fk, parent, key, "_ok", spread_nulls_by)
    return flagged.where(F.col("_ok") | F.col(fk).isNull()).drop("_ok")


def orphan_count(child: DataFrame, fk: str, parent: DataFrame, key: str) -> DataFrame:
    """One row: how many child rows have no parent.

    Child rows are counted per key first, so what meets the parent is one row
    per distinct key however often a key repeats.
    """
    per_key = child.groupBy(F.col(fk).alias("_fk")).agg(F.count("*").alias("_n"))
    unmatched = per_key.join(_keys(parent, key, "_pk"), F.col("_fk") == F.col("_pk"), "left_anti")
    return unmatched.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("huerfanos"))


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def label_rows(df: DataFrame, **labels: Column | str) -> DataFrame:
    """Put constant label columns in front of a frame."""
    return df.select(*[(F.lit(v) if isinstance(v, str) else v).alias(k) for k, v in labels.items()], *df.columns)
