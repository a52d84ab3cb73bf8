"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

#: Settings every job wants. Join sides are broadcast only when Spark's own
#: size check (static, then adaptive on real shuffle sizes) finds them small.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Where that is unset a folder under the warehouse stands in, but only with a
    local master: on a cluster every machine would write to its own disk and a
    later read would miss rows without an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", "")
    if named:
        return named
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError(f"set spark.checkpoint.dir to a folder that all machines of {master} share")
    return os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "_scratch")


def together(*writes: Callable[[], object]) -> list:
    """Run independent table writes at the same time and wait for all of them.

    Small tables then use the cores a large one leaves idle; Spark decides what
    runs where. The first failure is raised.
    """
    with ThreadPoolExecutor(max_workers=len(writes)) as pool:
        return [done.result() for done in [pool.submit(write) for write in writes]]


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once as Parquet in the shared folder and read it back.

    For frames that several branches of one job read: each branch then scans
    only the columns and row groups it needs instead of recomputing the lineage.
    The files lie under the application's id and go when the driver ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder; the driver's JVM deletes what lies there when it ends."""
    folder = os.path.join(shared_dir(spark), "stage", spark.sparkContext.applicationId)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop_path = jvm.org.apache.hadoop.fs.Path(folder)
    files = hadoop_path.getFileSystem(conf)
    files.mkdirs(hadoop_path)  # only what exists can be marked
    files.deleteOnExit(hadoop_path)
    return os.path.join(folder, f"{name}-{uuid.uuid4().hex}")
