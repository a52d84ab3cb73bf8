"""Runs on top of earlier runs: what they clean equals a rebuild, what they leave alone keeps its files."""

import datetime as dt
import os
import random
from decimal import Decimal
from functools import partial

import pytest
from pyspark.sql import functions as F

from granero.catalog import RETURNS, SALES, STORES, TABLES, TableSpec
from granero.operators import ingest
from granero.operators.dedup import deduplicate, drop_exact, first_per_key
from granero.operators.ingest import INGEST_PARTITIONS, day_prints, late, late_by_day, mark_of, newest, stamp
from granero.plans import refresh as plan_
from granero.plans.refresh import Run, _audited, _read_marked, clean_all, ingest_all, read_bronze, read_silver
from granero.sources.tables import Layers, live_batches, put_batch, read_newest, read_table, settle

from tests.conftest import plan, rows

KV = "id bigint, d date, v string"


def day(n):
    return dt.date(2001, 1, 1) + dt.timedelta(days=n)


class Spec:
    key, watermark = "id", "d"


# ------------------------------------------------------------ batches, base, newest
def random_batch(rnd, n):
    return [(rnd.choice([None, *range(12)]), rnd.choice([None, day(rnd.randrange(70))]), rnd.choice("abc")) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_settled_rows_and_batches_give_the_rows_of_all_batches(spark, tmp_path, seed):
    rnd = random.Random(seed)
    path, plain = str(tmp_path / "t"), str(tmp_path / "plain")
    frames = [stamp(spark.createDataFrame(random_batch(rnd, rnd.randrange(1, 9)), KV), f"2002-01-{n + 1:02d} 02:00:00", "s", f"b{n}") for n in range(6)]
    schema = frames[0].schema
    for n, frame in enumerate(frames):
        put_batch(frame, path, f"b{n}", INGEST_PARTITIONS)
        put_batch(frame, plain, f"b{n}", INGEST_PARTITIONS)
        if n in (2, 4):
            settle(spark, path, "id", schema, [f"b{n}"], ["d"])
        got = rows(read_newest(spark, path, "id", schema))
        assert got == rows(newest(read_table(spark, plain, schema=schema), "id"))
    base, batches = live_batches(spark, path)
    assert base and sorted(batches) == ["__lote=b4", "__lote=b5"]
    assert sorted(n for n in os.listdir(path) if n[0] != ".") == ["__lote=+base", "__lote=b2", "__lote=b3", "__lote=b4", "__lote=b5"]
    with pytest.raises(ValueError, match="settled"):
        put_batch(frames[0], path, "b0")
    with pytest.raises(ValueError, match="settled"):
        read_newest(spark, path, "id", schema, without=["b1"])
    again = rows(read_newest(spark, path, "id", schema))
    put_batch(frames[5], path, "b5", INGEST_PARTITIONS)  # the last run may be repeated
    assert rows(read_newest(spark, path, "id", schema)) == again


def test_a_settling_that_breaks_off_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(3):
        put_batch(stamp(spark.createDataFrame([(n, day(n), "a"), (9, day(n), f"v{n}")], KV), f"2002-01-0{n + 1} 02:00:00", "s", f"b{n}"), path, f"b{n}")
    schema = read_table(spark, path).schema
    before = rows(read_newest(spark, path, "id", schema))
    settle(spark, path, "id", schema, ["b2"])
    base, _ = live_batches(spark, path)
    os.remove(f"{base}/_SUCCESS")  # as if the write had not been finished
    assert live_batches(spark, path)[0] is None and rows(read_newest(spark, path, "id", schema)) == before
    settle(spark, path, "id", schema, ["b2"])
    assert rows(read_newest(spark, path, "id", schema)) == before


def test_newest_reads_the_columns_it_is_asked_for(spark, tmp_path):
    path = str(tmp_path / "t")
    batch = stamp(spark.range(50).select("id", F.lit(day(0)).alias("d"), F.lit("x").alias("v")), "2002-01-01 02:00:00", "s", "b1")
    put_batch(batch, path, "b1")
    put_batch(batch, path, "b2")
    settle(spark, path, "id", batch.schema, ["b2"])
    keyed = read_newest(spark, path, "id", batch.schema).where("id IS NOT NULL").select("id", "d")
    scans = [node for node in plan(keyed).split("\n\n") if "ReadSchema" in node]
    wide = [node for node in scans if "v:string" in node or "_sistema_fuente" in node]
    assert len(scans) > len(wide) and all("IsNull(id)" in node for node in wide)  # rows without a key only
    settled = read_newest(spark, path, "id", batch.schema, without=["b2"]).select("id", "d")
    assert "Exchange" not in plan(settled, "simple")  # a base alone is not ranked


# ------------------------------------------------------------ watermark and late rows by day
@pytest.mark.parametrize("seed", range(4))
def test_late_rows_by_day_equal_the_full_join(spark, seed):
    rnd = random.Random(seed)
    all_rows = [(i if rnd.random() > 0.05 else None, rnd.choice([None, day(rnd.randrange(40))]), "a") for i in range(200)]
    loaded = spark.createDataFrame([r for r in all_rows if rnd.random() > 0.08 * seed], KV)
    moved = [(i, day(rnd.randrange(40)) if rnd.random() < 0.05 * seed else d, v) for i, d, v in all_rows]
    source = spark.createDataFrame([*moved, (500, day(60), "future")], KV)
    prints = day_prints(loaded, Spec)
    as_of = day(rnd.choice([25, 100]))
    mark = mark_of(prints, as_of)
    assert mark == ingest.watermark(loaded, "d", as_of).first()["watermark"]
    got = late_by_day(source, loaded, prints, Spec, mark)
    assert (got.count() if got is not None else 0) == late(source, loaded, Spec, as_of).count()
    few = late_by_day(source, loaded, prints, Spec, mark, days=1)
    assert (rows(few) if few is not None else []) == rows(late(source, loaded, Spec, as_of))


def test_no_join_when_every_day_agrees(spark):
    loaded = spark.createDataFrame([(i, day(i % 5), "a") for i in range(40)], KV)
    assert late_by_day(loaded, loaded, day_prints(loaded, Spec), Spec, day(4)) is None
    swapped = loaded.withColumn("id", F.when(F.col("id") == 0, 99).otherwise(F.col("id")))  # as many keys, another one
    assert rows(late_by_day(swapped, loaded, day_prints(loaded, Spec), Spec, day(4)), "id") == [(99,)]


# ------------------------------------------------------------ counting in the cleaning pass
def test_copies_are_counted_where_rows_are_dropped(spark):
    columns = ["id_trans", "id_miembro", "id_tienda", "art_id", "fec_trans", "hra_trans", "qty_vendida"]
    data = [(i, None if i % 3 else 7, i % 2, 1, day(0), "08:00:00", i % 4) for i in range(20)] + [(3, None, 1, 1, day(0), "08:00:00", 9)]
    df = spark.createDataFrame(data, "id_trans bigint, id_miembro bigint, id_tienda bigint, art_id bigint, fec_trans date, hra_trans string, qty_vendida int")
    counted = deduplicate(df, SALES, copies="n")
    assert rows(counted.drop("n").select(*columns)) == rows(first_per_key(df, SALES.business_key, [F.col("id_trans").asc_nulls_first()]))
    assert counted.agg(F.sum("n")).first()[0] == 21
    assert rows(drop_exact(df.union(df), "n").drop("n")) == rows(drop_exact(df))


# ------------------------------------------------------------ whole runs
def world(spark, rnd):
    """Small tables whose rows refer to each other, with parents that may be missing or come later."""
    stores = [(i, f"t{i}", "HIPER", 1, "CO", 10, True, day(i)) for i in range(1, 4)]
    articles = [(i, None, f"a{i}", 1, 11, None, 1 + i % 2, 5, None, "UN", True, day(i)) for i in range(1, 5)]
    sales = [
        (i, None, rnd.randrange(1, 5), rnd.randrange(1, 6), day(rnd.randrange(150)), f"{rnd.randrange(3):02d}:00:00", 1, rnd.choice([5, 5, 5, -1]), None, "PSE", "WEB")
        for i in range(60)
    ]
    returns = [(i, rnd.randrange(70), rnd.randrange(1, 6), rnd.randrange(1, 5), day(rnd.randrange(200)), 1, "OTRO", "WEB", "APROBADA", None) for i in range(40)]
    stock = [(i, rnd.randrange(1, 6), rnd.randrange(1, 5), day(rnd.randrange(90)), 3, None, None, 1, 2) for i in range(30)]
    return {
        "mstr_proveedores": [(1, "p", "CO", 1, None, True)],
        "mstr_tiendas": stores,
        "mstr_articulos": articles,
        "crm_miembros": [(1, day(1), None, None, None, None, True, None)],
        "trans_ventas": sales,
        "inv_stock_diario": stock,
        "post_devoluciones": returns,
    }


def grown(rnd, tables):
    """The next delivery: corrected rows, new rows, and parents that were missing."""
    new = {name: list(data) for name, data in tables.items()}
    new["mstr_proveedores"].append((2, "q", "MX", 1, None, True))
    new["mstr_tiendas"].append((4, "t4", "SUPER", 1, "MX", 10, True, day(rnd.randrange(20))))
    new["mstr_articulos"].append((5, None, "a5", 2, 21, None, 1, 5, None, "UN", True, day(30)))
    sales = new["trans_ventas"]
    for at in rnd.sample(range(len(sales)), 6):  # a price, a date or an article is corrected
        row = list(sales[at])
        row[7], row[4], row[3] = rnd.choice([5, -1]), day(rnd.randrange(150)), rnd.randrange(1, 6)
        sales[at] = tuple(row)
    sales += [(100 + i, None, 1, 1, day(150 + i), "09:00:00", 1, 5, None, "PSE", "WEB") for i in range(3)]
    sales += [(60 + i, None, 1, 1, day(rnd.randrange(150)), "10:00:00", 1, 5, None, "PSE", "WEB") for i in range(6)]
    new["post_devoluciones"] += [(200, 100, 1, 1, day(160), 1, "OTRO", "WEB", "APROBADA", None)]
    return new


def frames(spark, tables):
    def build(name):
        schema = TABLES[name].schema
        money = [f.dataType.typeName() == "decimal" for f in schema]
        data = [tuple(Decimal(v) if m and v is not None else v for v, m in zip(r, money, strict=True)) for r in tables[name]]
        return spark.createDataFrame(data, schema)

    return {name: partial(build, name) for name in TABLES}


def silver_of(spark, layers):
    kept = {}
    for name, spec in TABLES.items():
        kept[name] = rows(_read_marked(spark, layers, spec).drop("_ts_silver").select(*spec.column_names, "motivo", "_copias"))
    kept["errores"] = rows(read_table(spark, layers.path("silver", "_errores")).drop("_ts_error"))
    kept["calidad"] = rows(read_table(spark, layers.path("silver", "_reporte_calidad")).drop("_ts_reporte"))
    return kept


@pytest.mark.parametrize("seed, runs", [(1, 3), (2, 2)])
def test_incremental_cleaning_equals_a_rebuild(spark, tmp_path, seed, runs):
    """Corrected and new rows, a parent that becomes valid (and so its children's children), a run date that moves on."""
    rnd = random.Random(seed)
    tables = world(spark, rnd)
    layers = Layers(str(tmp_path / "lake"))
    for n in range(runs):
        # Full loads, so that rows behind the watermark and corrected ones come in; the cleaning is told that it may build on what is there.
        run = Run(day(130 + 15 * n), f"2002-01-0{n + 1} 02:00:00", f"b{n}", "s", settle_after=2)
        ingest_all(spark, layers, frames(spark, tables), Run(run.as_of, run.ts, run.batch_id, "s", incremental=False, settle_after=2))
        written = clean_all(spark, layers, run)
        assert (written["trans_ventas"] is None) == (n == 0)
        got = silver_of(spark, layers)
        rebuilt = Layers(str(tmp_path / "lake"))
        clean_all(spark, rebuilt, Run(run.as_of, run.ts, run.batch_id, "s", incremental=False))
        assert got == silver_of(spark, rebuilt), n
        tables = grown(rnd, tables)


def files_of(folder):
    found = {}
    for root, _, names in os.walk(folder):
        found.update({os.path.join(root, n): os.stat(os.path.join(root, n)).st_mtime_ns for n in names if n.endswith(".parquet")})
    return found


def test_months_that_no_row_touches_keep_their_files(spark, tmp_path):
    rnd = random.Random(9)
    tables = world(spark, rnd)
    layers = Layers(str(tmp_path / "lake"))

    def run(n, **kw):
        r = Run(day(400), f"2002-01-0{n} 02:00:00", f"b{n}", "s", **kw)
        ingest_all(spark, layers, frames(spark, tables), r)
        return clean_all(spark, layers, r)

    run(1)
    before = files_of(layers.path("silver", "trans_ventas"))
    tables["trans_ventas"].append((900, None, 1, 2, day(151), "09:00:00", 1, 5, None, "PSE", "WEB"))  # behind the last day
    written = run(2)
    assert written["trans_ventas"] == [dt.date(2001, 6, 1)] and written["inv_stock_diario"] == []
    after = files_of(layers.path("silver", "trans_ventas"))
    elsewhere = {k: v for k, v in before.items() if "_mes=2001-06" not in k}
    assert elsewhere and all(after.get(k) == v for k, v in elsewhere.items())
    assert read_silver(spark, layers, SALES).where("id_trans = 900").count() == 1

    # A return comes before its sale and is rejected; with the sale its month is cleaned again.
    last = max(r[4] for r in tables["post_devoluciones"])
    tables["post_devoluciones"].append((903, 904, 2, 1, last + dt.timedelta(1), 1, "OTRO", "WEB", "APROBADA", None))
    run(3)
    assert read_silver(spark, layers, RETURNS).where("id_devolucion = 903").count() == 0
    tables["trans_ventas"].append((904, None, 1, 2, day(153), "09:00:00", 1, 5, None, "PSE", "WEB"))
    written = run(4)
    assert written["post_devoluciones"] == [(last + dt.timedelta(1)).replace(day=1)]
    assert read_silver(spark, layers, RETURNS).where("id_devolucion = 903").count() == 1


def test_a_run_after_one_that_broke_off_cleans_everything(spark, tmp_path, monkeypatch):
    tables = world(spark, random.Random(4))
    layers = Layers(str(tmp_path / "lake"))

    def run(n):
        r = Run(day(400), f"2002-01-0{n} 02:00:00", f"b{n}", "s")
        ingest_all(spark, layers, frames(spark, tables), r)
        return clean_all(spark, layers, r)

    run(1)
    tables["trans_ventas"].append((900, None, 1, 2, day(151), "09:00:00", 1, 5, None, "PSE", "WEB"))
    with monkeypatch.context() as m:
        m.setattr(plan_, "quality_counted", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run(2)
    assert run(3)["trans_ventas"] is None and read_silver(spark, layers, SALES).where("id_trans = 900").count() == 1
    assert run(4)["trans_ventas"] == []


def test_watermark_reads_no_sales(spark, tmp_path, monkeypatch):
    """What was loaded per day is noted; the second run asks the notes, and agrees with the table."""
    tables = world(spark, random.Random(4))
    layers = Layers(str(tmp_path / "lake"))
    ingest_all(spark, layers, frames(spark, tables), Run(day(100), "2002-01-01 02:00:00", "b1", "s"))
    run = Run(day(100), "2002-01-02 02:00:00", "b2", "s")
    prints = plan_._prints(spark, layers, SALES, read_bronze(spark, layers, SALES), run)
    text = plan(prints.agg(F.max("dia")))
    assert "id_trans" not in text and "_huellas" in text
    assert mark_of(prints, run.as_of) == ingest.watermark(read_bronze(spark, layers, SALES), "fec_trans", run.as_of).first()[0]
    assert not _audited(STORES).fieldNames() == _audited(SALES).fieldNames()


def test_slices_must_hold_whole_business_keys():
    with pytest.raises(ValueError, match="several months"):
        TableSpec("t", "id", (), business_key=("a",), sliced_by="d")
