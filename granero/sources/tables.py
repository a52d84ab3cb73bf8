"""Tables by layer and path: read, replace, append, store batches, export, describe."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from granero.catalog import TableSpec
from granero.operators.ingest import NEWEST, check_upsert_keys, keys_in_both, newest
from granero.operators.references import union_all
from granero.session import stage


@dataclass(frozen=True)
class Layers:
    """Where the tables of each layer live."""

    root: str
    fmt: str = "parquet"

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"


def _fs_path(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(conf), hadoop_path


# Folders are named like partitions, so that Spark reads several of them as one table.
_VERSION = re.compile(r"__version=(\d{10})-[0-9a-f]{32}")
_BATCH = "__lote="
_BASE = "__lote=+base"  # no batch id is quoted like this
_MEMBERS = "_lotes"
_DONE = "_SUCCESS"


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs_path(spark, path)
    return sorted(entry.getPath().getName() for entry in fs.listStatus(p)) if fs.exists(p) else []


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Finished versions of a table, oldest first: those whose write has put its mark, the last thing it does."""
    found = [name for name in _names(spark, path) if _VERSION.fullmatch(name)]
    return [f"{path}/{name}" for name in found if _DONE in _names(spark, f"{path}/{name}")]


def _base(spark: SparkSession, path: str, names: Sequence[str]) -> tuple[str | None, set[str]]:
    """The settled rows of a table made of batches, and the folders of the batches that they stand for."""
    versions = _versions(spark, f"{path}/{_BASE}") if _BASE in names else []
    return (versions[-1], set(_names(spark, f"{versions[-1]}/{_MEMBERS}"))) if versions else (None, set())


def live_batches(spark: SparkSession, path: str, without: Sequence[str] = ()) -> tuple[str | None, dict[str, str]]:
    """The settled rows of a table made of batches, and the newest version of each batch beyond them, by folder name."""
    path = path.rstrip("/")
    names = _names(spark, path)
    base, members = _base(spark, path, names)
    hidden = {batch_folder(batch) for batch in without}
    if lost := hidden & members:
        raise ValueError(f"{sorted(lost)[0]} of {path} is settled and cannot be told apart any more")
    folders = [n for n in names if n.startswith(_BATCH) and n != _BASE and n not in members and n not in hidden]
    found = {name: _versions(spark, f"{path}/{name}") for name in folders}
    return base, {name: versions[-1] for name, versions in found.items() if versions}


def live_paths(spark: SparkSession, path: str, without: Sequence[str] = ()) -> list[str]:
    """Folders whose files are the table: its newest version, its settled rows and the newest version of each batch
    beyond them, or the path itself.

    ``without`` leaves out batches by id.
    """
    path = path.rstrip("/")
    names = _names(spark, path)
    if any(name.startswith(_BATCH) for name in names):
        base, batches = live_batches(spark, path, without)
        return [*([base] if base else []), *batches.values()]
    if any(_VERSION.fullmatch(name) for name in names):
        return _versions(spark, path)[-1:]
    return [path] if any("=" in name or not name.startswith(("_", ".")) for name in names) else []


def table_exists(spark: SparkSession, path: str) -> bool:
    """Does the path hold a table: a finished version or batch, data files or partition folders?"""
    return bool(live_paths(spark, path))


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
    without: Sequence[str] = (),
) -> DataFrame:
    """The rows of a table as it is now; later writes do not change a frame that was read before."""
    paths = live_paths(spark, path, without)
    if not paths and schema is not None and _names(spark, path):
        return spark.createDataFrame([], schema)
    return _load(spark, path, paths or [path], fmt, schema)


def _load(spark: SparkSession, path: str, paths: Sequence[str], fmt: str, schema: T.StructType | str | None) -> DataFrame:
    reader = spark.read.format(fmt).option("basePath", path)
    rows = (reader.schema(schema) if schema is not None else reader).load(list(paths))
    return rows.drop(_BATCH[:-1], "__version")


def read_newest(
    spark: SparkSession,
    path: str,
    key: str,
    schema: T.StructType,
    by: Sequence[str] = NEWEST,
    fmt: str = "parquet",
    without: Sequence[str] = (),
    only: Sequence[str] | None = None,
    keys_first: bool = True,
) -> DataFrame:
    """The valid rows of a table made of batches: settled rows stay where they are, batches beyond them are ranked.

    The rows of one batch are those of one run and replace none of each other, so a single batch is read as it is.
    ``only`` reads nothing but these batches. Which keys of the batches are settled too is looked for at once and written
    in the shared folder, so that whole rows need not move to find it; ``keys_first`` switches that off for who may not
    read the rows, or of few days and columns.
    """
    path = path.rstrip("/")
    base, batches = live_batches(spark, path, without)
    if only is not None:
        base, batches = None, {n: p for n, p in batches.items() if n in {batch_folder(b) for b in only}}
    empty = spark.createDataFrame([], schema)
    later = _load(spark, path, list(batches.values()), fmt, schema) if batches else empty
    if base is None:
        return later if len(batches) < 2 else newest(later, key, by)
    settled = _load(spark, path, [base], fmt, schema)
    if not batches:
        return settled
    return newest(later, key, by, settled, stage(keys_in_both(later, settled, key), "claves") if keys_first else None)


def settle(
    spark: SparkSession,
    path: str,
    key: str,
    schema: T.StructType,
    keep: Sequence[str] = (),
    order: Sequence[str] = (),
    by: Sequence[str] = NEWEST,
    fmt: str = "parquet",
) -> None:
    """Bring all batches but ``keep`` down to their valid rows and store these as the base of the table.

    Batches that are settled are read no more and cannot be written again; their
    folders go with the next settling, as a reader may still hold them. The base
    counts from its mark on, like any version, and names its batches from the
    start: a run that breaks off leaves the table as it was. ``order`` sorts the
    rows over all files, so that a filter on it reads few of them.
    """
    path = path.rstrip("/")
    old, gone = _base(spark, path, _names(spark, path))
    _, batches = live_batches(spark, path, keep)
    if not batches:
        return
    rows = read_newest(spark, path, key, schema, by, fmt, keep)
    if order:
        rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    replace_table(rows, f"{path}/{_BASE}", fmt=fmt, members=[*gone, *batches])
    for name in gone:
        fs, folder = _fs_path(spark, f"{path}/{name}")
        fs.delete(folder, True)


def replace_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    gather: bool = False,
    fmt: str = "parquet",
    members: Sequence[str] = (),
) -> None:
    """Write a table anew, its schema included, as a new version beside the old one.

    A version counts from the moment Spark marks its write as complete, so a run
    that breaks off at any point leaves either the old table or the new one, and
    running it again gives the new one. Nothing is moved or copied. The
    version before stays for readers that still hold it; older ones go.
    With ``gather`` the rows of an output partition are brought together first:
    rebalancing merges small partitions and splits one that is too large for a
    task, so a hot date costs more files and not one endless task.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    numbers = [int(m[1]) for m in map(_VERSION.fullmatch, _names(spark, path)) if m]
    fresh = f"{path}/__version={max(numbers, default=0) + 1:010d}-{uuid.uuid4().hex}"
    rows = df.hint("rebalance", *partition_by) if gather and partition_by else df
    for name in members:  # batches that this version stands for
        fs, folder = _fs_path(spark, f"{fresh}/{_MEMBERS}/{name}")
        fs.mkdirs(folder)
    rows.write.format(fmt).mode("append").partitionBy(*partition_by).save(fresh)
    fs, mark = _fs_path(spark, f"{fresh}/{_DONE}")
    if not fs.exists(mark):  # marks can be switched off
        fs.create(mark).close()
    kept = _versions(spark, path)[-2:]
    for name in _names(spark, path):
        if _VERSION.fullmatch(name) and f"{path}/{name}" < kept[0]:
            fs, old = _fs_path(spark, f"{path}/{name}")
            fs.delete(old, True)


def overwrite_slices(
    df: DataFrame, path: str, by: str, slices: Sequence | None = None, fmt: str = "parquet", gather: bool = True
) -> None:
    """Write the partitions in ``slices`` anew and leave the files of all others alone; without ``slices`` the whole table.

    ``df`` holds all rows of these partitions and must not read ``path``. One
    that has no rows any more is removed. A run that breaks off between two
    partitions is repeated by its caller; one writer per table. Without ``gather``
    rows are written where they are, for those of a single partition.
    """
    mode = "static" if slices is None else "dynamic"
    rows = df.hint("rebalance", by) if gather else df
    rows.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(by).save(path)
    if slices is not None:
        filled = {r[0] for r in df.select(by).distinct().collect()}  # at most one row per slice
        for lost in set(slices) - filled:
            fs, folder = _fs_path(df.sparkSession, f"{path.rstrip('/')}/{by}={lost}")
            fs.delete(folder, True)


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet") -> None:
    df.write.format(fmt).mode("append").partitionBy(*partition_by).save(path)


def batch_folder(batch_id: str) -> str:
    return _BATCH + quote(batch_id, safe="")


def put_batch(
    df: DataFrame, path: str, batch_id: str, partition_by: Sequence[str] = (), fmt: str = "parquet"
) -> DataFrame:
    """Store the rows of one run in a table made of batches; returns them as stored.

    A batch that is written again takes the place of what it wrote before, so a
    run can be repeated. A batch that broke off does not count. The table is
    neither read nor rewritten: which row of a key is valid is decided by its
    readers (:func:`granero.operators.ingest.newest`).
    """
    path = path.rstrip("/")
    if batch_folder(batch_id) in _base(df.sparkSession, path, _names(df.sparkSession, path))[1]:
        raise ValueError(f"batch {batch_id} of {path} is settled and cannot be written again")
    folder = f"{path}/{batch_folder(batch_id)}"
    replace_table(df, folder, partition_by, fmt=fmt)
    return read_table(df.sparkSession, folder, fmt, df.schema)


def save_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """Store a frame by buckets of ``key``, each sorted, and return it as read back.

    A join on the key then moves the other side only. Buckets are known to the
    catalog, not to the files, so the table is registered; its rows are brought
    together first, one file per bucket.
    """
    rows = df.repartition(buckets, key)
    rows.write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return df.sparkSession.table(table)


#: Types that hold every value of another one.
_WIDER = {
    "byte": ("short", "integer", "long", "double"),
    "short": ("integer", "long", "double"),
    "integer": ("long", "double"),
    "float": ("double",),
    "date": ("timestamp_ntz",),
}


def widest(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The one of two types that holds the values of both; None if neither does."""
    if a == b:
        return a
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        whole, scale = max(a.precision - a.scale, b.precision - b.scale), max(a.scale, b.scale)
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None
    if b.typeName() in _WIDER.get(a.typeName(), ()):
        return b
    return a if a.typeName() in _WIDER.get(b.typeName(), ()) else None


def reconciled(schemas: Sequence[T.StructType]) -> T.StructType:
    """One schema for batches that were stored one after the other, oldest first.

    Columns stand in the order in which they first appeared; one that came later
    or was dropped is null where it is missing. A type may grow. One that shrinks
    or changes its kind is refused, as the rows stored before would not fit.
    """
    types: dict[str, T.DataType] = {}
    for schema in schemas:
        for field in schema.fields:
            known = types.get(field.name, field.dataType)
            wide = widest(known, field.dataType)
            if wide != field.dataType:
                raise ValueError(f"{field.name} was stored as {known.simpleString()} and cannot become {field.dataType.simpleString()}")
            types[field.name] = wide
    return T.StructType([T.StructField(name, kind, True) for name, kind in types.items()])


def read_reconciled(spark: SparkSession, path: str, order: Sequence[str], fmt: str = "parquet") -> DataFrame:
    """All batches of a table whose schema has changed between them; ``order`` names the batches, oldest first.

    Each batch is read with the columns it has, from its own footers, and cast to
    the common schema; which columns are asked for still reaches every scan.
    """
    _, batches = live_batches(spark, path)
    stored = [batches[batch_folder(b)] for b in order if batch_folder(b) in batches]
    frames = [spark.read.format(fmt).option("basePath", folder).load(folder) for folder in stored]
    target = reconciled([f.schema for f in frames])
    return union_all(
        f.select(*[(F.col(c.name) if c.name in f.columns else F.lit(None)).cast(c.dataType).alias(c.name) for c in target.fields])
        for f in frames
    )


def merge_into_catalog(changes: DataFrame, table: str, key: str) -> None:
    """The same upsert for a catalog table whose format has row-level merge."""
    check_upsert_keys(changes, key)
    (
        changes.alias("s")
        .mergeInto(table, F.expr(f"{table}.{key} = s.{key}"))
        .whenMatched()
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )


def export(
    df: DataFrame, name: str, folder: str, formats: Sequence[str], sample_rows: int = 0, order: Sequence[str] = ()
) -> dict[str, str]:
    """Write a table as csv, parquet (snappy) and/or JSON lines, plus an optional sample csv."""
    writers = {
        "csv": lambda w, p: w.option("header", True).csv(p),
        "parquet": lambda w, p: w.option("compression", "snappy").parquet(p),
        "json": lambda w, p: w.json(p),
    }
    unknown = [f for f in formats if f not in writers]
    if unknown:
        raise ValueError(f"unsupported format: {unknown[0]}")
    paths = {}
    for fmt in formats:
        paths[fmt] = os.path.join(folder, f"{name}.{fmt}")
        writers[fmt](df.write.mode("overwrite"), paths[fmt])
    if sample_rows > 0:
        paths["sample"] = os.path.join(folder, f"{name}_muestra.csv")
        writers["csv"](preview(df, order or df.columns[:1], sample_rows).write.mode("overwrite"), paths["sample"])
    return paths


def preview(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """First ``n`` rows in a fixed order."""
    return df.orderBy(*order).limit(n)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(tabla, filas) of several tables in one job."""
    return union_all(
        df.agg(F.count("*").alias("filas")).select(F.lit(name).alias("tabla"), "filas") for name, df in tables.items()
    )


def load_files(
    spark: SparkSession, specs: Sequence[TableSpec], folder: str, run_ts: str, database: str | None = None
) -> DataFrame:
    """Register ``<folder>/<table>.parquet`` files as managed tables; returns the load metadata."""
    import time

    records = []
    for spec in specs:
        started = time.monotonic()
        name = f"{database}.{spec.name}" if database else spec.name
        spark.read.parquet(f"{folder}/{spec.name}.parquet").write.mode("overwrite").saveAsTable(name)
        records.append((spec.name, round(time.monotonic() - started, 1)))
    seconds = spark.createDataFrame(records, "tabla string, segundos_carga double")
    loaded = row_counts({s.name: spark.table(f"{database}.{s.name}" if database else s.name) for s in specs})
    metadata = (
        loaded.withColumnRenamed("filas", "filas_cargadas")
        .join(seconds, "tabla")
        .withColumn("fecha_carga", F.lit(run_ts).cast("timestamp"))
    )
    name = f"{database}._metadata_carga_fuente" if database else "_metadata_carga_fuente"
    metadata.write.mode("overwrite").saveAsTable(name)
    return spark.table(name)


def describe(spark: SparkSession, database: str | None = None) -> DataFrame:
    """(tabla, columna, tipo) of every table of a database."""
    names = [t.name for t in spark.catalog.listTables(database) if not t.isTemporary]
    rows = [
        (n, f.name, f.dataType.simpleString())
        for n in names
        for f in spark.table(f"{database}.{n}" if database else n).schema.fields
    ]
    names = ("tabla", "columna", "tipo")
    if not rows:
        return spark.range(0).select(*[F.lit("").alias(c) for c in names])
    listed = F.array(*[F.struct(*[F.lit(v).alias(c) for c, v in zip(names, row, strict=True)]) for row in rows])
    return spark.range(1).select(F.inline(listed))
