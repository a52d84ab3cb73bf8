import datetime as dt
import glob
import os

import pytest
from pyspark.sql import Window, functions as F

from granero.catalog import MEMBERS, STORES, SUPPLIERS
from granero.operators import ingest
from granero.operators.ingest import INGEST_PARTITIONS, stamp
from granero.session import together
from granero.sources import retail
from granero.sources import tables
from granero.sources.tables import (
    Layers, append_table, describe, export, live_paths, load_files, preview, put_batch, read_table, replace_table,
    row_counts, table_exists,
)
from granero.streaming.ingest import load_new_files, read_loaded

from tests.conftest import rows

KV = "id bigint, d date, v string"


def day(n):
    return dt.date(2001, 1, 1) + dt.timedelta(days=n)


def frame(spark, *records):
    return spark.createDataFrame(list(records), KV)


def stamped(df, n, batch):
    return stamp(df, f"2002-01-{n:02d} 02:00:00", "retail", batch)


class Spec:
    key, watermark = "id", "d"


def test_stamp_and_drop(spark):
    df = stamped(frame(spark, (1, day(0), "a")), 5, "b5")
    got = df.first()
    assert (got["_sistema_fuente"], got["_batch_id"]) == ("retail", "b5")
    assert [got[c] for c in INGEST_PARTITIONS] == [2002, 1, 5]
    assert ingest.drop_audit(df).columns == ["id", "d", "v"]


def test_increment_modes(spark):
    src = frame(spark, (1, day(0), "a"), (2, day(1), "b"), (3, day(2), "c"), (4, None, "d"))
    loaded = src.where("id <= 2")
    assert rows(ingest.increment(src, loaded, Spec), "id") == [(3,)]  # strictly after, a null date is not
    assert ingest.increment(src, loaded, Spec, incremental=False).count() == 4
    assert ingest.increment(src, None, Spec).count() == 4
    assert ingest.increment(src, src.limit(0), Spec).count() == 4  # nothing loaded: no watermark
    assert ingest.increment(src, loaded, SUPPLIERS).count() == 4  # no date column: always everything


def test_future_date_does_not_stop_the_load_when_capped(spark):
    src = frame(spark, (1, day(0), "a"), (2, dt.date(2027, 1, 1), "bad"), (3, day(3), "c"))
    loaded = src.where("id <= 2")
    assert ingest.increment(src, loaded, Spec).count() == 0
    assert rows(ingest.increment(src, loaded, Spec, as_of=day(30)), "id") == [(2,), (3,)]


def test_late_rows(spark):
    src = frame(spark, (1, day(5), "a"), (2, day(1), "late"), (3, day(9), "new"))
    assert rows(ingest.late(src, src.where("id = 1"), Spec), "id") == [(2,)]


def test_upsert_and_key_checks(spark):
    target = frame(spark, (1, day(0), "a"), (2, day(0), "b"))
    changes = frame(spark, (2, day(1), "B"), (3, day(1), "C"))
    once = ingest.upsert(target, changes, "id")
    assert rows(once, "id", "v") == [(1, "a"), (2, "B"), (3, "C")]
    assert rows(ingest.upsert(once, changes, "id")) == rows(once)
    assert rows(ingest.upsert(target, changes.limit(0), "id")) == rows(target)
    assert ingest.check_upsert_keys(changes, "id") == (2, 3)
    assert ingest.check_upsert_keys(changes.limit(0), "id") is None
    with pytest.raises(ValueError, match="1 repeated"):
        ingest.check_upsert_keys(changes.unionByName(changes.where("id = 2")), "id")
    with pytest.raises(ValueError, match="1 null"):
        ingest.check_upsert_keys(frame(spark, (None, day(0), "x")), "id")


def put(df, path, batch_id):
    return put_batch(df, path, batch_id, INGEST_PARTITIONS)


def valid(spark, path, **kw):
    return ingest.newest(read_table(spark, path, **kw), "id")


def test_batches_and_newest_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    first = stamped(spark.range(1000).select("id", F.lit(day(0)).alias("d"), F.lit("a").alias("v")).repartition(4), 1, "b1")
    assert put(first, path, "b1").count() == 1000
    changes = stamped(frame(spark, (5, day(2), "X"), (3000, day(2), "Y")), 3, "b3")
    put(changes, path, "b/3 ñ")
    assert read_table(spark, path).count() == 1002 and valid(spark, path).count() == 1001
    assert rows(valid(spark, path).where("v <> 'a'"), "id", "v", "_dia_ingesta") == [(5, "X", 3), (3000, "Y", 3)]
    once = rows(valid(spark, path))
    put(changes, path, "b/3 ñ")  # the run again
    assert rows(valid(spark, path)) == once
    assert rows(valid(spark, path, without=["b/3 ñ"])) == rows(first)
    put(changes.limit(0), path, "b/3 ñ")  # a run that now finds nothing takes its rows back
    assert rows(valid(spark, path, schema=changes.schema)) == rows(first)


def test_bad_keys_are_stored_for_the_cleaning(spark, tmp_path):
    path = str(tmp_path / "t")
    copies = [(1, day(0), "a"), (1, day(0), "a"), (None, day(0), "x"), (None, day(0), "x"), (2, day(0), "b")]
    put(stamped(frame(spark, *copies), 1, "b1"), path, "b1")
    assert rows(valid(spark, path), "id", "v").count((1, "a")) == 2
    put(stamped(frame(spark, (None, day(0), "x"), (None, day(0), "y"), (2, day(1), "B")), 2, "b2"), path, "b2")
    assert rows(valid(spark, path), "id", "v") == [(1, "a"), (1, "a"), (2, "B"), (None, "x"), (None, "y")]


def test_empty_source_leaves_a_readable_table(spark, tmp_path):
    path = str(tmp_path / "t")
    empty = stamped(frame(spark, (1, day(0), "a")).limit(0), 1, "b1")
    assert put(empty, path, "b1").count() == 0
    assert table_exists(spark, path) and read_table(spark, path, schema=empty.schema).count() == 0


class Broken(Exception):
    pass


@pytest.mark.parametrize("step", ["write", "mark", "clean"])
@pytest.mark.parametrize("kind", ["replace", "batch"])
def test_a_run_that_breaks_off_leaves_the_old_or_the_new_table(spark, tmp_path, monkeypatch, step, kind):
    path = str(tmp_path / "t")
    old, new = frame(spark, (1, day(0), "old")), frame(spark, (1, day(0), "new"), (2, day(0), "new"))

    def write(df):
        return replace_table(df, path) if kind == "replace" else put_batch(df, path, "b1")

    for _ in range(3):
        write(old)
    if step == "write":  # files are there, the mark is not
        write(new)
        (newest,) = [p for p in live_paths(spark, path)]
        os.remove(f"{newest}/_SUCCESS")
    else:
        broken = "_fs_path" if step == "mark" else "_versions"
        with monkeypatch.context() as m:
            m.setattr(tables, broken, lambda *a: (_ for _ in ()).throw(Broken()))
            with pytest.raises(Broken):
                write(new)
    found = rows(read_table(spark, path), "v")
    assert found in ([("old",)], [("new",), ("new",)])
    write(new)  # the run again
    assert rows(read_table(spark, path), "v") == [("new",), ("new",)]
    write(old)
    write(old)
    assert rows(read_table(spark, path), "v") == [("old",)]
    folder = path if kind == "replace" else f"{path}/__lote=b1"
    assert len([n for n in os.listdir(folder) if n.startswith("__version=")]) == 2  # the rest is cleared


def test_a_frame_read_before_a_write_stays_readable(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(frame(spark, (1, day(0), "a")), path)
    held = read_table(spark, path)
    replace_table(frame(spark, (2, day(0), "b")), path)
    assert rows(held, "id") == [(1,)] and rows(read_table(spark, path), "id") == [(2,)]


def test_replace_append_and_partitions(spark, tmp_path):
    path = str(tmp_path / "a" / "t")
    replace_table(frame(spark, (1, day(0), "a")), path)
    replace_table(read_table(spark, path).withColumn("extra", F.lit(1)), path)  # reads what it replaces
    assert read_table(spark, path).columns == ["id", "d", "v", "extra"]
    other = str(tmp_path / "log")
    append_table(read_table(spark, path), other)
    append_table(read_table(spark, path), other)
    assert read_table(spark, other).count() == 2
    days = spark.range(500).select("id", F.when(F.col("id") < 300, day(0)).otherwise(day(1)).alias("d"))
    replace_table(days, path, ["d"], gather=True)
    (current,) = live_paths(spark, path)
    assert sorted(os.listdir(current))[-2:] == ["d=2001-01-01", "d=2001-01-02"]
    assert read_table(spark, path).where(F.col("d") == day(0)).count() == 300


def test_together_runs_all_and_raises_the_failure():
    assert together(lambda: 1, lambda: 2) == [1, 2]
    with pytest.raises(ZeroDivisionError):
        together(lambda: 1, lambda: 1 // 0)


def test_export(spark, tmp_path):
    df = spark.range(30).select("id", F.lit("ñ").alias("t"))
    paths = export(df, "x", str(tmp_path), ["csv", "parquet", "json"], sample_rows=5, order=["id"])
    assert spark.read.csv(paths["csv"], header=True).count() == 30
    assert rows(spark.read.parquet(paths["parquet"])) == rows(df)
    assert glob.glob(paths["parquet"] + "/*.snappy.parquet")
    assert spark.read.json(paths["json"]).where("t = 'ñ'").count() == 30
    assert rows(spark.read.csv(paths["sample"], header=True, schema="id bigint, t string"), "id") == [(i,) for i in range(5)]
    with pytest.raises(ValueError, match="unsupported format: xls"):
        export(df, "y", str(tmp_path), ["csv", "xls"])
    assert not os.path.exists(tmp_path / "y.csv")


def test_load_files_registers_counts_and_describes(spark, small, tmp_path):
    specs = [STORES, MEMBERS]
    for spec in specs:
        retail.source(spark, small, spec.name).write.parquet(f"{tmp_path}/{spec.name}.parquet")
    meta = load_files(spark, specs, str(tmp_path), "2002-01-01 02:00:00")
    assert rows(meta, "tabla", "filas_cargadas") == [("crm_miembros", 150), ("mstr_tiendas", 10)]
    assert rows(row_counts({s.name: spark.table(s.name) for s in specs})) == [("crm_miembros", 150), ("mstr_tiendas", 10)]
    listed = describe(spark)
    assert listed.where("tabla = 'mstr_tiendas' and columna = 'fec_apertura'").first()["tipo"] == "date"
    assert preview(spark.table("crm_miembros"), ["id_miembro"], 3).count() == 3
    assert Layers("/x/", "parquet").path("gold", "t") == "/x/gold/t"


def test_file_discovery_loads_late_and_corrected_rows_once(spark, small, tmp_path):
    landing, target, state = (str(tmp_path / n) for n in ("landing", "bronze", "state"))
    members = retail.members(spark, small)

    def run(ts):
        load_new_files(spark, landing, MEMBERS, target, state, ts, "crm").awaitTermination()
        return read_loaded(spark, target, MEMBERS)

    newer = members.where("fec_registro > '1990-03-01'")
    newer.write.mode("append").parquet(landing)
    assert run("2002-01-01 02:00:00").count() == newer.count()
    late = members.where("fec_registro <= '1990-03-01'")
    late.unionByName(newer.limit(3).withColumn("genero", F.lit("X"))).coalesce(1).write.mode("append").parquet(landing)
    table = run("2002-01-02 02:00:00")
    assert table.count() == 150 and table.select("id_miembro").distinct().count() == 150
    assert table.where("_dia_ingesta = 2").count() == late.count() + 3
    assert run("2002-01-03 02:00:00").where("_dia_ingesta = 3").count() == 0


@pytest.mark.parametrize("files_per_batch", [1, 2, 1000])
def test_grouping_of_files_does_not_matter(spark, small, tmp_path, files_per_batch):
    """An older date never replaces a newer one; of equal dates the file that arrived last counts."""
    landing, target, state = (str(tmp_path / n) for n in ("landing", "bronze", "state"))
    one = retail.members(spark, small).where("fec_registro IS NOT NULL").limit(1)
    for i, (date, genre) in enumerate([("1999-01-01", "A"), ("1995-01-01", "B"), ("1999-01-01", "C"), ("1990-01-01", "D")]):
        row = one.withColumns({"fec_registro": F.lit(date).cast("date"), "genero": F.lit(genre)})
        row.coalesce(1).write.mode("append").parquet(landing)
        for name in glob.glob(f"{landing}/*.parquet"):
            if os.path.getmtime(name) > 10**9 + 100:
                os.utime(name, (10**9 + i, 10**9 + i))
    load_new_files(spark, landing, MEMBERS, target, state, "2002-01-01 02:00:00", "crm", files_per_batch).awaitTermination()
    assert rows(read_loaded(spark, target, MEMBERS), "genero", F.col("fec_registro").cast("string")) == [("C", "1999-01-01")]


def test_shared_folder_on_a_cluster_must_be_named(spark, monkeypatch):
    from granero import session

    class Context:
        master = "spark://host:7077"

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session())


def test_ids_have_room(spark, tmp_path):
    """More than a thousand lines in an order and more than a hundred thousand stores: no id twice."""
    line = dict(l_quantity=1.0, l_extendedprice=1.0, l_discount=0.0, l_tax=0.0, l_returnflag="R", l_linestatus="F", l_shipdate="1995-01-01")
    data = [dict(l_orderkey=o, l_partkey=7, l_suppkey=s, l_linenumber=s, **line) for o in (1, 2) for s in range(1, 1300)]
    data += [dict(l_orderkey=3, l_partkey=p, l_suppkey=s, l_linenumber=1, **line) for p in (7, 8) for s in (5, 100_005, 200_005)]
    source = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    cast = [F.col(c).cast(t).alias(c) for c, t in source.select(*data[0]).dtypes]
    frame_ = spark.createDataFrame(data).select(*cast)
    frame_.withColumns({c: F.lit(None).cast(t) for c, t in source.dtypes if c not in frame_.columns}).write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").limit(3)
    orders.withColumn("o_orderkey", F.row_number().over(Window.orderBy("o_orderkey")).cast("bigint")).write.parquet(f"{tmp_path}/orders.parquet")
    spark.read.parquet("/root/testdata/sf0.001/part.parquet").write.parquet(f"{tmp_path}/part.parquet")
    for name, key in (("trans_ventas", "id_trans"), ("inv_stock_diario", "id_snapshot")):
        got = retail.source(spark, str(tmp_path), name)
        assert got.count() == got.select(key).distinct().count() > 0, name


def test_watermark_row_of_an_empty_table(spark):
    from granero.plans import queries

    empty = spark.createDataFrame([], KV)
    marks = empty.agg(F.lit(None).cast("date").alias("watermark")).count()
    assert marks == 1 and queries.QUERIES["watermark"]
