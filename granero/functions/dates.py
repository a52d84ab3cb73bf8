"""Date builders: reference date, trailing windows, calendar attributes."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Spanish names, January first and Sunday first.
MONTH_NAMES = (
    "enero", "febrero", "marzo", "abril", "mayo", "junio",
    "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre",
)
DAY_NAMES = ("domingo", "lunes", "martes", "miercoles", "jueves", "viernes", "sabado")
# End of fixed values.
NO_DATE = dt.date(1900, 1, 1)


def latest_date(df: DataFrame, col: str) -> Column:
    """Latest date of a table, as a literal.

    One value is fetched, once. As a literal it prunes the partitions and row
    groups of every later scan, which a value known only at run time may not.
    """
    return F.lit(df.agg(F.max(col)).first()[0]).cast("date")


def within_trailing(col: str, ref: Column, days: int) -> Column:
    """True in the ``days`` days that end at ``ref`` (lower bound excluded)."""
    return F.col(col) > F.date_sub(ref, days)


def month_of(col: str) -> Column:
    """First day of the month of a date, by which tables are stored in slices; rows without a date share one."""
    return F.coalesce(F.trunc(col, "MM"), F.lit(NO_DATE)).cast("date")


def in_months(col: str, months: Sequence[dt.date]) -> Column:
    """True for dates of the given slices; also names the span, which prunes row groups of files that are sorted by date."""
    dated = sorted(m for m in months if m != NO_DATE)
    found = F.col(col).isNull() if NO_DATE in months else F.lit(False)
    if dated:
        span = (F.col(col) >= F.lit(dated[0])) & (F.col(col) <= F.last_day(F.lit(dated[-1])))
        found = found | (span & F.trunc(col, "MM").isin(*dated))
    return found


def _name(names: tuple[str, ...], one_based: Column) -> Column:
    return F.get(F.array(*[F.lit(n) for n in names]), one_based - 1)


def calendar_columns(day: str) -> list[Column]:
    """Calendar attributes of a date column, Sunday = 1, ISO week number."""
    d = F.col(day)
    return [
        F.year(d).alias("anio"),
        F.quarter(d).alias("trimestre"),
        F.month(d).alias("mes"),
        _name(MONTH_NAMES, F.month(d)).alias("nombre_mes"),
        F.dayofmonth(d).alias("dia"),
        F.dayofweek(d).alias("dia_semana"),
        _name(DAY_NAMES, F.dayofweek(d)).alias("nombre_dia"),
        F.weekofyear(d).alias("semana_anio"),
        F.dayofweek(d).isin(1, 7).alias("es_fin_semana"),
    ]
