"""Incremental load by file discovery instead of a date watermark.

Each new file is loaded once, whatever dates it holds, so rows that arrive late
are not skipped. Every micro-batch is stored as a batch of the table; which row
of a key is valid is decided from all of them, by its date and then by the
arrival of its file, so it does not matter how files were grouped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.query import StreamingQuery

from granero.catalog import TableSpec
from granero.operators.dedup import first_per_key
from granero.operators.ingest import INGEST_PARTITIONS, newest, stamp
from granero.sources.tables import put_batch, read_table

#: When the file of a row was written, and its name.
ARRIVAL = ["_llegada", "_archivo"]


def _precedence(spec: TableSpec) -> list[str]:
    return [*([spec.watermark] if spec.watermark else []), *ARRIVAL]


def load_new_files(
    spark: SparkSession,
    landing: str,
    spec: TableSpec,
    target: str,
    checkpoint: str,
    run_ts: str,
    system: str,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Store every file not seen before, then stop; ``files_per_batch`` bounds a micro-batch and changes no result.

    Of a key that occurs more than once in a micro-batch only the row that will
    win is stored. Rows without a key are all stored. A micro-batch that is
    repeated after a failure takes the place of its first attempt.
    """
    landed = spark.readStream.schema(spec.schema).option("maxFilesPerTrigger", files_per_batch).parquet(landing)
    files = landed.select(
        "*",
        F.col("_metadata.file_modification_time").alias("_llegada"),
        F.col("_metadata.file_name").alias("_archivo"),
    )
    order = [F.col(c).desc_nulls_last() for c in _precedence(spec)]

    def load(batch: DataFrame, number: int) -> None:
        keyed = first_per_key(batch.where(F.col(spec.key).isNotNull()), [spec.key], order)
        rows = keyed.unionByName(batch.where(F.col(spec.key).isNull()))
        name = f"{run_ts}#{number}"
        put_batch(stamp(rows, run_ts, system, name), target, name, INGEST_PARTITIONS)

    return (
        files.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_loaded(spark: SparkSession, target: str, spec: TableSpec) -> DataFrame:
    """The valid rows: per key the latest date, of equal dates the file that arrived last."""
    audit = [("_ts_ingesta", T.TimestampType()), ("_sistema_fuente", T.StringType()), ("_batch_id", T.StringType())]
    arrival = [("_llegada", T.TimestampType()), ("_archivo", T.StringType())]
    days = [(c, T.IntegerType()) for c in INGEST_PARTITIONS]
    schema = T.StructType(spec.schema.fields + [T.StructField(n, t, True) for n, t in [*arrival, *audit, *days]])
    return newest(read_table(spark, target, schema=schema), spec.key, _precedence(spec)).drop(*ARRIVAL)
