"""Sales measures over the star: additive parts first, ratios at the end."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, functions as F

from granero.functions.columns import as_double, average, percent, ratio
from granero.operators.references import left_lookup

#: Additive parts: name -> aggregate over sale lines.
_PARTS = {
    "_neto": lambda: F.sum("vr_venta_neto"),
    "_bruto": lambda: F.sum("vr_venta_bruto"),
    "_descuento": lambda: F.sum("descuento_aplicado"),
    "_unidades": lambda: F.sum("qty_vendida").cast("bigint"),
    "_lineas": lambda: F.count(F.lit(1)),
    "_con_descuento": lambda: F.count_if("ind_descuento"),
    "_transacciones": lambda: F.count("id_trans"),
}

#: Published measures: name -> (parts it needs, expression over them).
MEASURES = {
    "ventas_netas": (("_neto",), lambda: as_double(F.col("_neto"))),
    "venta_bruta": (("_bruto",), lambda: as_double(F.col("_bruto"))),
    "descuento_total": (("_descuento",), lambda: as_double(F.col("_descuento"))),
    "tasa_descuento": (("_descuento", "_bruto"), lambda: ratio(F.col("_descuento"), F.col("_bruto"))),
    "unidades": (("_unidades",), lambda: F.col("_unidades")),
    "transacciones": (("_transacciones",), lambda: F.col("_transacciones")),
    # net per transaction, recomputed for each slice
    "ticket_promedio": (("_neto", "_transacciones"), lambda: ratio(F.col("_neto"), F.col("_transacciones"))),
    # net per sale line, as the stored aggregates have it
    "ticket_promedio_linea": (("_neto", "_lineas"), lambda: average(F.col("_neto"), F.col("_lineas"))),
    # share of discounted lines, not the discount rate
    "pct_con_descuento": (("_con_descuento", "_lineas"), lambda: percent(F.col("_con_descuento"), F.col("_lineas"))),
}


def is_unique(rows: DataFrame, key: str) -> bool:
    """Does every row have a key of its own? One pass over a written table."""
    repeated = rows.groupBy(key).count().where((F.col("count") > 1) | F.col(key).isNull())
    return repeated.limit(1).count() == 0


@dataclass(frozen=True)
class Star:
    """Sales and their dimensions, each under the sales column that refers to it.

    Transactions are counted as distinct ids. ``unique_lines`` states that
    ``id_trans`` was found to be unique in these sales (:func:`is_unique`);
    counting distinct ids is then counting rows and needs no shuffle of the ids.
    """

    sales: DataFrame
    dims: Mapping[str, DataFrame]
    unique_lines: bool = False

    def lookups(self, by: Sequence[str]) -> list[tuple[str, DataFrame]]:
        """Dimensions, cut to what is needed, that own attributes in ``by``."""
        found = []
        for key, dim in self.dims.items():
            owned = [c for c in by if c in dim.columns and c not in self.sales.columns]
            if owned:
                found.append((key, dim.select(key, *owned)))
        return found

    def enriched(self, attributes: Sequence[str]) -> DataFrame:
        """Sales with the given dimension attributes; unmatched sales stay, with nulls."""
        out = self.sales
        for key, dim in self.lookups(attributes):
            out = left_lookup(out, dim, key, spread_nulls_by="id_trans" if key == "id_miembro" else None)
        return out

    def where(self, condition: Column) -> Star:
        return replace(self, sales=self.sales.where(condition))

    def with_columns(self, **cols: Column) -> Star:
        return replace(self, sales=self.sales.withColumns(cols))


def parts_by(star: Star, by: Sequence[str], parts: Sequence[str], coarse: bool = True) -> DataFrame:
    """Additive parts per group.

    With ``coarse`` the sales are first summed per dimension key, then the keys
    are looked up and summed again: the lookup meets one row per key instead of
    one per sale, however large or skewed the dimension is. Without it (results
    nearly as fine as the sales) and for distinct ids, which cannot be summed,
    attributes are looked up first and there is one aggregation.
    """
    lookups = star.lookups(by)
    distinct = "_transacciones" in parts and not star.unique_lines
    if not lookups or not coarse or distinct:
        aggs = {p: _PARTS[p]() for p in parts}
        if distinct:
            aggs["_transacciones"] = F.count_distinct("id_trans")
        return star.enriched(by).groupBy(*by).agg(*[a.alias(p) for p, a in aggs.items()])
    own = [c for c in by if c in star.sales.columns]
    grain = list(dict.fromkeys(own + [key for key, _ in lookups]))
    sums = star.sales.groupBy(*grain).agg(*[_PARTS[p]().alias(p) for p in parts])
    for key, dim in lookups:
        sums = left_lookup(sums, dim, key)
    if set(grain) <= set(by):
        return sums.select(*by, *parts)
    return sums.groupBy(*by).agg(*[F.sum(p).alias(p) for p in parts])


def measures_by(star: Star, by: Sequence[str], names: Sequence[str], coarse: bool = True) -> DataFrame:
    parts = list(dict.fromkeys(p for n in names for p in MEASURES[n][0]))
    return parts_by(star, by, parts, coarse).select(*by, *[MEASURES[n][1]().alias(n) for n in names])


def sliced(
    star: Star,
    first_day: dt.date | None = None,
    last_day: dt.date | None = None,
    countries: Sequence[str] | None = None,
    channels: Sequence[str] | None = None,
    categories: Sequence[str] | None = None,
) -> DataFrame:
    """Enriched sales under the report's slicers; blank country or category is left out."""
    sales = star
    if first_day is not None:
        sales = sales.where(F.col("fec_trans") >= F.lit(first_day))
    if last_day is not None:
        sales = sales.where(F.col("fec_trans") <= F.lit(last_day))
    if channels:
        sales = sales.where(F.col("canal_venta").isin(*channels))
    out = sales.enriched(["id_pais", "categoria_n1"])
    for col, wanted in (("id_pais", countries), ("categoria_n1", categories)):
        out = out.where(F.col(col).isNotNull() & (F.col(col) != ""))
        if wanted:
            out = out.where(F.col(col).isin(*wanted))
    return out


def _week_before(by: Sequence[str], day: str) -> Column:
    """The value exactly seven days earlier in the same group; null when that day is missing."""
    return F.sum("_neto").over(Window.partitionBy(*by).orderBy(F.unix_date(day)).rangeBetween(-7, -7))


def _compared(daily: DataFrame, by: Sequence[str], day: str) -> DataFrame:
    now, before = as_double(F.col("_neto")), as_double(F.col("_anterior"))
    return daily.withColumn("_anterior", _week_before(by, day)).select(
        F.col(day).alias("fecha"),
        *by,
        now.alias("ventas_netas"),
        before.alias("ventas_semana_anterior"),
        F.try_divide(now - before, before).alias("variacion_semanal"),
    )


def same_day_last_week(star: Star, by: Sequence[str] = ()) -> DataFrame:
    """Daily net sales next to those of the same weekday one week before."""
    return _compared(parts_by(star, ["fec_trans", *by], ["_neto"]), by, "fec_trans")


def daily_trend(star: Star, calendar: DataFrame) -> DataFrame:
    """The same comparison on every calendar day, sales or not (one row per day)."""
    daily = parts_by(star, ["fec_trans"], ["_neto"])
    dense = calendar.select("fecha").join(daily, F.col("fecha") == F.col("fec_trans"), "left").drop("fec_trans")
    return _compared(dense, [], "fecha")


#: Accuracy of the sketches: 2 ** 12 registers, standard error 1.3 %.
SKETCH_BITS = 12
SKETCH_ERROR = 0.04  # three standard errors


def sketched_parts(star: Star, by: Sequence[str], parts: Sequence[str]) -> DataFrame:
    """Additive parts per group and a sketch of its transaction ids, ``_boceto``.

    Unlike counts of distinct ids, sketches of days or stores can be merged: a
    stored table of these parts answers for any slice without a look at the
    sales. They are small (4 KB at most) and built before the shuffle.
    """
    sketch = F.hll_sketch_agg("id_trans", F.lit(SKETCH_BITS)).alias("_boceto")
    return star.enriched(by).groupBy(*by).agg(*[_PARTS[p]().alias(p) for p in parts], sketch)


def merged_sketches(parts: DataFrame, by: Sequence[str], sums: Sequence[str] = ()) -> DataFrame:
    """Parts summed to a coarser grain, with ``transacciones_aprox`` from the merged sketches (exact counts stay the default)."""
    merged = F.hll_sketch_estimate(F.hll_union_agg("_boceto")).alias("transacciones_aprox")
    return parts.groupBy(*by).agg(*[F.sum(p).alias(p) for p in sums], merged)


def _first(i: int) -> str:
    return f"_primeras_{i}"


def _cells_with_firsts(star: Star, by: Sequence[str], sets: Sequence[Sequence[str]], parts: Sequence[str]) -> DataFrame:
    """Additive parts per cell of the finest grain, and for each set how many ids have their first row of a cell there.

    Summed to the cells of its set, that is the number of distinct ids. Sales
    are brought together by id, once for all sets, and summed where they lie.
    """
    sums = [_PARTS[p]().alias(p) for p in dict.fromkeys([*parts, "_lineas"])]
    of_id = star.enriched(by).repartition("id_trans").groupBy("id_trans", *by).agg(*sums)
    firsts = {}
    for i, s in enumerate(sets):
        first, rest = F.col("id_trans").isNotNull(), [c for c in by if c not in s]
        if rest:  # else an id has one row in the cell
            same = [c for c in by if c in s]
            first = first & (F.row_number().over(Window.partitionBy("id_trans", *same).orderBy(*rest)) == 1)
        firsts[_first(i)] = first.cast("bigint")
    return of_id.withColumns(firsts).groupBy(*by).agg(*[F.sum(c).alias(c) for c in [*parts, *firsts]])


def measures_by_sets(star: Star, sets: Sequence[Sequence[str]], names: Sequence[str]) -> DataFrame:
    """Measures of several grains from one scan of the sales: the cells of a matrix, its subtotals and its total.

    Columns that a row is summed over are null; ``nivel`` tells them from
    values that are null: bit i, counted from the last column, is set when the
    column is summed over. Ratios come from the sums of their own grain. Where
    transaction ids are unique, sales are summed per dimension key first, so that
    what is repeated for every set is one row per key. Distinct ids cannot be
    summed; but the rows of an id that come first in a cell of a set can, see
    :func:`_cells_with_firsts`. What is repeated is one row per cell there too.
    """
    by = list(dict.fromkeys(c for s in sets for c in s))
    parts = list(dict.fromkeys(p for n in names for p in MEASURES[n][0]))
    columns = [[F.col(c) for c in s] for s in sets]
    aggs = {p: F.sum(p) for p in parts}
    if "_transacciones" in parts and not star.unique_lines:
        rows = _cells_with_firsts(star, by, sets, [p for p in parts if p != "_transacciones"])
        levels = [sum(1 << i for i, c in enumerate(reversed(by)) if c not in s) for s in sets]
        firsts = [F.when(F.grouping_id() == level, F.sum(_first(i))) for i, level in enumerate(levels)]
        aggs["_transacciones"] = F.coalesce(*firsts)
    else:
        rows = parts_by(star, by, parts)
    grouped = rows.groupingSets(columns, *by).agg(*[a.alias(p) for p, a in aggs.items()], F.grouping_id().cast("int").alias("nivel"))
    return grouped.select(*by, "nivel", *[MEASURES[n][1]().alias(n) for n in names])
