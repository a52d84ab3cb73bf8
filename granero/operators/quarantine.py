"""Single-pass rejection: each row gets the first reason that applies, or none."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from granero.catalog import TABLES, TableSpec
from granero.operators.references import PackedKeys, with_match_flag

REASON = "motivo"


def _rule_cases(spec: TableSpec, as_of: dt.date, report_nulls: bool) -> list[tuple[str, Column]]:
    cases = [("pk_nula", F.col(spec.key).isNull())]
    for rule in spec.rules:
        if report_nulls:
            cases.append((f"null_{rule.column}", F.col(rule.column).isNull()))
        cases.append((rule.reason, F.expr(rule.reject.format(as_of=f"DATE '{as_of.isoformat()}'"))))
    return cases


def tag(
    df: DataFrame,
    spec: TableSpec,
    as_of: dt.date,
    parents: Mapping[str, DataFrame | PackedKeys] | None = None,
    report_nulls: bool = True,
) -> DataFrame:
    """Add ``motivo``: the first failing check in declared order, null for a valid row.

    Order: missing key, business rules, then foreign keys. ``parents`` holds the
    already cleaned parent tables; without it foreign keys are not checked.
    A null in a rule column fails no comparison; it is reported under its own
    reason, or with ``report_nulls=False`` the row is left out of both sides,
    neither kept nor listed.
    """
    cases = _rule_cases(spec, as_of, report_nulls)
    if not report_nulls:
        for rule in spec.rules:
            df = df.where(F.col(spec.key).isNull() | F.col(rule.column).isNotNull())
    flags: list[str] = []
    for ref in spec.references if parents is not None else ():
        flag = f"_ok_{ref.column}"
        spread = spec.key if ref.null_ok else None
        df = with_match_flag(df, ref.column, parents[ref.parent], TABLES[ref.parent].key, flag, spread)
        failed = ~F.col(flag)
        if ref.null_ok:
            failed = failed & F.col(ref.column).isNotNull()
        cases.append((f"fk_invalida_{ref.column}", failed))
        flags.append(flag)
    reason = F.coalesce(*[F.when(failed, F.lit(name)) for name, failed in cases])
    return df.withColumn(REASON, reason).drop(*flags)


def valid(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(REASON).isNull()).drop(REASON)


def rejected(tagged: DataFrame, spec: TableSpec) -> DataFrame:
    """Error rows: table, record id as text, reason."""
    return tagged.where(F.col(REASON).isNotNull()).select(
        F.lit(spec.name).alias("tabla_origen"), F.col(spec.key).cast("string").alias("id_registro"), REASON
    )


def error_summary(errors: DataFrame) -> DataFrame:
    return errors.groupBy("tabla_origen", REASON).agg(F.count("*").alias("registros"))


def outcome(tagged: DataFrame) -> DataFrame:
    """One row: how many rows were rejected and how many are kept."""
    return tagged.agg(
        F.count_if(F.col(REASON).isNotNull()).alias("rechazados"), F.count_if(F.col(REASON).isNull()).alias("salida")
    )


def quality_row(table: str, rows_in: DataFrame, tagged: DataFrame) -> DataFrame:
    """Quality report line of a table: what came in, what was dropped, what stays.

    ``rows_in`` is the raw table. Its count reads no columns, and duplicates are
    what is missing from the tagged rows. The one-row counts meet as scalar
    subqueries.
    """
    total = rows_in.agg(F.count("*").alias("n")).scalar()
    return _quality_line(table, outcome(tagged).withColumn("entrada", total))


def quality_counted(table: str, tagged: DataFrame, copies: str) -> DataFrame:
    """The same line from tagged rows that say how many raw rows they stand for: the raw table is not read for it."""
    came_in = F.coalesce(F.sum(copies), F.lit(0)).cast("bigint").alias("entrada")
    bad = F.col(REASON).isNotNull()
    return _quality_line(table, tagged.agg(came_in, F.count_if(bad).alias("rechazados"), F.count_if(~bad).alias("salida")))


def _quality_line(table: str, counts: DataFrame) -> DataFrame:
    kept, out = F.col("salida"), F.col("rechazados")
    share = F.bround(F.try_divide(F.lit(100.0) * kept.cast("double"), F.col("entrada").cast("double")), 2)
    return counts.select(
        F.lit(table).alias("tabla"),
        "entrada",
        (F.col("entrada") - kept - out).alias("duplicados"),
        "rechazados",
        "salida",
        F.coalesce(share, F.lit(0.0)).alias("pct_conformes"),
    )
