"""Run volumes and the volume alert."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def run_volumes(log: DataFrame) -> DataFrame:
    return log.groupBy("batch_id").agg(
        F.sum("registros").cast("bigint").alias("volumen"), F.max("ts_ejecucion").alias("ts")
    )


def volume_alert(log: DataFrame, history: int = 7, threshold_pct: float = 30.0) -> DataFrame:
    """Latest run against the mean of up to ``history`` runs before it.

    Empty while there is only one run. The log has one row per table and run;
    the newest ``history + 1`` runs are all that is compared.
    """
    recent = run_volumes(log).orderBy(F.desc("ts"), F.desc("batch_id")).limit(history + 1)
    before = Window.orderBy("ts", "batch_id").rowsBetween(-history, -1)
    compared = recent.select(
        "batch_id",
        "volumen",
        F.avg("volumen").over(before).alias("_media"),
        F.row_number().over(Window.orderBy(F.desc("ts"), F.desc("batch_id"))).alias("_n"),
    ).where((F.col("_n") == 1) & F.col("_media").isNotNull())
    deviation = F.coalesce(F.try_divide(F.lit(100.0) * (F.col("volumen") - F.col("_media")), F.col("_media")), F.lit(0.0))
    return compared.select(
        "batch_id",
        F.col("volumen").alias("volumen_actual"),
        F.bround("_media", 0).alias("promedio_previo"),
        F.bround(deviation, 1).alias("desviacion_pct"),
        (F.abs(deviation) > threshold_pct).alias("es_anomalia"),
    )
