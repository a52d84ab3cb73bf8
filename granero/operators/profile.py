"""Profiles and contract checks; each reads its table once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F, types as T

from granero.catalog import TableSpec
from granero.operators.ranking import exact_quantiles


def _long(one_row: DataFrame, name: str, value: str) -> DataFrame:
    """A one-row frame of counts turned into (name, value) rows."""
    return one_row.unpivot([], one_row.columns, name, value)


def value_shares(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows and share of each value (null included) of each listed column."""
    tagged = F.explode(
        F.array(*[F.struct(F.lit(c).alias("columna"), F.col(c).cast("string").alias("valor")) for c in cols])
    )
    counts = df.select(tagged.alias("x")).groupBy("x.columna", "x.valor").agg(F.count("*").alias("filas"))
    total = df.agg(F.count("*").alias("n")).scalar()
    return counts.withColumn("proporcion", F.col("filas").cast("double") / total.cast("double"))


def null_profile(df: DataFrame) -> DataFrame:
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return _long(counts, "columna", "nulos")


def numeric_summary(df: DataFrame, col: str) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles of a column."""
    c = F.col(col)
    quartiles = exact_quantiles(df, col, {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    base = df.agg(
        F.count(c).alias("filas"),
        (F.sum(c).cast("double") / F.count(c)).alias("media"),
        F.stddev_samp(c.cast("double")).alias("desviacion"),
        F.min(c).cast("double").alias("minimo"),
        F.max(c).cast("double").alias("maximo"),
    )
    found = quartiles.select(F.struct("*").alias("q")).scalar()
    return base.select(F.lit(col).alias("columna"), "*", *[found.getField(q).alias(q) for q in quartiles.columns])


def month_histogram(df: DataFrame, day: str) -> DataFrame:
    return df.groupBy(F.month(day).alias("mes")).agg(F.count("*").alias("filas"))


def weight_shares(df: DataFrame, key: str, group: str, weights: Mapping[int, Decimal]) -> DataFrame:
    """Weight of each row: its group's weight split evenly over the group, normalised to one.

    Groups are counted first; a group's share does not need its rows together.
    The normaliser is the sum of the weights of the groups that occur.
    """
    entries = [F.lit(x) for pair in weights.items() for x in pair]
    sizes = (
        df.groupBy(group)
        .agg(F.count("*").alias("_n"))
        .withColumn("_peso", F.try_element_at(F.create_map(*entries), F.col(group)))
    )
    total = sizes.agg(F.sum("_peso").alias("s")).scalar()
    share = F.col("_peso").cast("double") / F.col("_n") / total.cast("double")
    per_row = sizes.select(group, F.col("_n").alias("articulos"), share.alias("peso"))
    return df.select(key, group).join(per_row, group, "left")


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Declared columns only, in declared order, cast to declared types.

    A value that does not fit its type becomes null and shows up in
    :func:`contract_violations`.
    """
    return df.select(
        *[
            F.col(c.name).try_cast(c.stored_type).alias(c.name)
            if c.name in df.columns
            else F.lit(None).cast(c.stored_type).alias(c.name)
            for c in spec.columns
        ]
    )


def _counts(df: DataFrame, table: str, rule: str, checks: Mapping[str, Column]) -> DataFrame:
    if not checks:
        checks = {"": F.lit(False)}
    counted = df.agg(*[F.count_if(broken).alias(c) for c, broken in checks.items()])
    return (
        _long(counted, "columna", "violaciones")
        .where("columna <> ''")
        .select(F.lit(table).alias("tabla"), "columna", F.lit(rule).alias("regla"), "violaciones")
    )


def contract_violations(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Per column: nulls where none are allowed, and texts over their length."""
    checks: dict[str, Column] = {}
    for c in spec.columns:
        broken = F.lit(False)
        if not c.nullable:
            broken = broken | F.col(c.name).isNull()
        if isinstance(c.type, T.VarcharType):
            broken = broken | F.coalesce(F.char_length(c.name) > c.type.length, F.lit(False))
        checks[c.name] = broken
    return _counts(df, spec.name, "contrato", checks)


def domain_violations(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Per coded column: non-null values outside the vocabulary."""
    checks = {c.name: F.col(c.name).isNotNull() & ~F.col(c.name).isin(*c.values) for c in spec.columns if c.values}
    return _counts(df, spec.name, "vocabulario", checks)
