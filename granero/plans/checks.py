"""Data-quality results and the daily run report, computed as tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from granero.operators.references import orphan_count, union_all
from granero.operators.volume import run_volumes


def _result(name: str, description: str, value: Column, ok: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check"),
        F.lit(description).alias("descripcion"),
        value.alias("valor_obtenido"),
        F.when(ok, "PASS").otherwise("FAIL").alias("estado"),
    )


def _none_expected(name: str, description: str, count: str, noun: str) -> Column:
    value = F.concat_ws(" ", F.col(count).cast("string"), F.lit(noun))
    return _result(name, description, value, F.col(count) == 0)


def _results(measured: DataFrame, *results: Column) -> DataFrame:
    """Result rows out of one row of figures, so that a table is read once for all its checks."""
    return measured.select(F.inline(F.array(*results)))


def unique_key(df: DataFrame, table: str, key: str) -> DataFrame:
    measured = df.agg(F.count("*").alias("n"), F.count_distinct(key).alias("d"))
    text = F.format_string(f"%d filas / %d {key} distintos", "n", "d")
    return _results(
        measured, _result(f"pk_unica_{table}", f"{key} sin duplicados", text, F.col("n") == F.col("d"))
    )


def dq_checks(
    products: DataFrame, stores: DataFrame, customers: DataFrame, sales: DataFrame, rfm: DataFrame, inventory: DataFrame
) -> DataFrame:
    """The eight checks on the model: check, descripcion, valor_obtenido, estado."""
    any_null = F.col("vr_venta_neto").isNull() | F.col("art_id").isNull() | F.col("id_tienda").isNull()
    lines = sales.agg(
        F.count_if(any_null).alias("nulos"), F.count_if(F.col("vr_venta_neto") <= 0).alias("no_positivos")
    )
    out_of_range = ~(F.col("R").between(1, 5) & F.col("F").between(1, 5) & F.col("M").between(1, 5))
    return union_all(
        [
            unique_key(products, "dim_productos", "art_id"),
            unique_key(stores, "dim_tiendas", "id_tienda"),
            unique_key(customers, "dim_clientes", "id_miembro"),
            _results(
                lines,
                _none_expected(
                    "no_nulos_fact_ventas", "vr_venta_neto, art_id e id_tienda no nulos", "nulos", "nulos"
                ),
                _none_expected("rango_vr_venta_neto", "vr_venta_neto > 0", "no_positivos", "no positivos"),
            ),
            _results(
                orphan_count(sales, "art_id", products, "art_id"),
                _none_expected(
                    "ri_ventas_productos", "fact_ventas.art_id existe en dim_productos", "huerfanos", "huerfanos"
                ),
            ),
            _results(
                rfm.agg(F.count_if(out_of_range).alias("fuera")),
                _none_expected("rango_scores_rfm", "R, F y M entre 1 y 5", "fuera", "fuera de rango"),
            ),
            _results(
                inventory.agg(F.count_if(F.col("cobertura_dias") < 0).alias("negativas")),
                _none_expected("rango_cobertura", "cobertura_dias >= 0 (o nula)", "negativas", "negativas"),
            ),
        ]
    )


def run_report(log: DataFrame, quality: DataFrame, checks: DataFrame, alerts: DataFrame) -> DataFrame:
    """One list of the day: volume of the latest run, rows kept per table, checks, alert."""
    latest = run_volumes(log).orderBy(F.desc("ts"), F.desc("batch_id")).limit(1)
    parts: Sequence[DataFrame] = [
        latest.select(
            F.lit("ingesta").alias("seccion"),
            F.col("batch_id").alias("nombre"),
            F.col("volumen").cast("string").alias("valor"),
            F.lit("OK").alias("estado"),
        ),
        quality.select(
            F.lit("calidad").alias("seccion"),
            F.col("tabla").alias("nombre"),
            F.col("salida").cast("string").alias("valor"),
            F.when(F.col("rechazados") > 0, "CON RECHAZOS").otherwise("OK").alias("estado"),
        ),
        checks.select(
            F.lit("verificacion").alias("seccion"),
            F.col("check").alias("nombre"),
            F.col("valor_obtenido").alias("valor"),
            "estado",
        ),
        alerts.select(
            F.lit("volumen").alias("seccion"),
            F.col("batch_id").alias("nombre"),
            F.col("volumen_actual").cast("string").alias("valor"),
            F.when(F.col("es_anomalia"), "ALERTA").otherwise("OK").alias("estado"),
        ),
    ]
    return union_all(parts)
