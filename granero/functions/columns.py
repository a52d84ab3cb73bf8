"""Column builders for labels, money, masking and ratios."""

from __future__ import annotations

from functools import reduce
from typing import Any, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

MONEY = T.DecimalType(18, 2)


def lookup(key: Column, entries: Mapping[Any, Any], default: Any) -> Column:
    """Label for a code out of a short fixed list, ``default`` for anything else."""
    pairs = [F.lit(x) for pair in entries.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), F.lit(default))


def first_match(cases: Sequence[tuple[Column, Any]], default: Any) -> Column:
    """Value of the first case whose condition holds."""
    return reduce(
        lambda rest, case: F.when(case[0], F.lit(case[1])).otherwise(rest),
        reversed(cases),
        F.lit(default),
    )


def money(amount: Column) -> Column:
    """Exact two-decimal amount (half-up), wide enough for line totals."""
    return F.round(amount, 2).cast(MONEY)


def as_double(exact: Column) -> Column:
    return exact.cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double quotient; null when the denominator is zero or null."""
    return F.try_divide(as_double(numerator), as_double(denominator))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """``100 * part / whole`` rounded half-up; null when ``whole`` is zero or null."""
    return F.round(F.try_divide(F.lit(100.0) * as_double(part), as_double(whole)), digits)


def average(total: Column, n: Column, digits: int = 2) -> Column:
    return F.round(ratio(total, n), digits)


def masked(col: str) -> Column:
    """Deterministic digest: equal inputs stay joinable, null stays null."""
    return F.sha2(F.col(col).cast("string"), 256)


def expose(df: DataFrame) -> DataFrame:
    """Exact decimals turned into doubles, the type the tables publish."""
    return df.select(
        *[
            F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )
