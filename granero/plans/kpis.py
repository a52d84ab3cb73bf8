"""Stored aggregates and KPIs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from granero.functions.columns import as_double, average, percent
from granero.operators.ranking import top_n
from granero.operators.references import left_lookup
from granero.plans.measures import Star, measures_by, parts_by


def agg_daily_sales(star: Star) -> DataFrame:
    """Per day, country, store, channel and category."""
    by = ["fec_trans", "id_pais", "id_tienda", "canal_venta", "categoria_n1"]
    names = ["ventas_netas", "unidades", "transacciones", "ticket_promedio_linea"]
    return measures_by(star, by, names, coarse=False).withColumnRenamed("ticket_promedio_linea", "ticket_promedio")


def kpi_country_channel(star: Star) -> DataFrame:
    names = ["ventas_netas", "unidades", "transacciones", "ticket_promedio_linea", "pct_con_descuento"]
    kpi = measures_by(star, ["id_pais", "canal_venta"], names)
    return kpi.withColumnRenamed("ticket_promedio_linea", "ticket_promedio").orderBy("id_pais", "canal_venta")


def return_rate(star: Star, returns: DataFrame) -> DataFrame:
    """Units returned per units sold, by category and channel of the sale cell.

    Both sides are summed per article before the category is looked up. Returns
    in a cell without sales have nothing to be compared with and are left out.
    """
    cell = ["categoria_n1", "canal_venta"]
    sold = parts_by(star, cell, ["_unidades"]).withColumnRenamed("_unidades", "unidades_vendidas")
    per_article = returns.groupBy("art_id", F.col("canal_devolucion").alias("canal_venta")).agg(
        F.sum("qty_devuelta").alias("_n")
    )
    returned = (
        left_lookup(per_article, star.dims["art_id"].select("art_id", "categoria_n1"), "art_id")
        .groupBy(*cell)
        .agg(F.sum("_n").cast("bigint").alias("unidades_devueltas"))
    )
    return (
        sold.join(returned, cell, "left")
        .fillna({"unidades_devueltas": 0})
        .withColumn("tasa_devolucion_pct", percent(F.col("unidades_devueltas"), F.col("unidades_vendidas")))
    )


def return_ratio_overall(sales: DataFrame, returns: DataFrame) -> DataFrame:
    returned = returns.agg(F.count("*").alias("n")).scalar()
    return sales.agg(F.count("*").alias("ventas")).select(
        returned.alias("devoluciones"),
        "ventas",
        F.try_divide(returned.cast("double"), F.col("ventas").cast("double")).alias("tasa"),
    )


def agg_rfm_segments(rfm: DataFrame) -> DataFrame:
    n = F.count("*")
    return (
        rfm.groupBy("etiqueta")
        .agg(
            n.alias("clientes"),
            average(F.sum("monetario"), n).alias("monetario_promedio"),
            average(F.sum("frecuencia"), n).alias("frecuencia_promedio"),
        )
        .orderBy(F.desc("clientes"), "etiqueta")
    )


def top_products(star: Star, n: int = 10, categories: Sequence[str] | None = None) -> DataFrame:
    """Best selling articles of each (or each listed) category by net sales; the smaller id wins a tie."""
    sold = measures_by(star, ["art_id", "categoria_n1"], ["ventas_netas", "unidades"])
    if categories is not None:
        sold = sold.where(F.col("categoria_n1").isin(*categories))
    ranked = top_n(sold, ["categoria_n1"], [F.desc("ventas_netas"), F.asc("art_id")], n)
    return ranked.orderBy("categoria_n1", "rank")


def weekly_sales(star: Star) -> DataFrame:
    """Net sales per country, calendar year and ISO week, against the row before.

    The year is the calendar year of each day, so the last days of December can
    fall under week 1 of the ending year; :func:`weekly_sales_iso` avoids that.
    """
    dated = star.with_columns(anio=F.year("fec_trans"), semana=F.weekofyear("fec_trans"))
    weekly = measures_by(dated, ["id_pais", "anio", "semana"], ["ventas_netas"])
    before = F.lag("ventas_netas").over(Window.partitionBy("id_pais").orderBy("anio", "semana"))
    return _with_change(weekly, before).orderBy("id_pais", "anio", "semana")


def weekly_sales_iso(star: Star) -> DataFrame:
    """The same by ISO year and week, compared with the week before or nothing."""
    monday = F.date_sub("fec_trans", F.weekday("fec_trans"))
    weekly = parts_by(star.with_columns(inicio_semana=monday), ["id_pais", "inicio_semana"], ["_neto"])
    by_day = Window.partitionBy("id_pais").orderBy(F.unix_date("inicio_semana")).rangeBetween(-7, -7)
    before = as_double(F.sum("_neto").over(by_day))
    thursday = F.date_add("inicio_semana", 3)
    named = weekly.withColumn("ventas_semana_anterior", before).select(
        "id_pais",
        F.year(thursday).alias("anio_iso"),
        F.weekofyear("inicio_semana").alias("semana"),
        as_double(F.col("_neto")).alias("ventas_netas"),
        "ventas_semana_anterior",
    )
    return _with_change(named, F.col("ventas_semana_anterior")).orderBy("id_pais", "anio_iso", "semana")


def _with_change(weekly: DataFrame, before: Column) -> DataFrame:
    now, prev = F.col("ventas_netas"), F.col("ventas_semana_anterior")
    return weekly.withColumn("ventas_semana_anterior", before).withColumn(
        "variacion_pct", F.round(F.try_divide(F.lit(100.0) * (now - prev), prev), 2)
    )
