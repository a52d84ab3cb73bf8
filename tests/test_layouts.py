"""Stored layouts and coarser grains: which files a filter opens, what moves in a join, ntile, sketches, matrices, schemas."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F, types as T

from granero.catalog import TABLES
from granero.functions.dates import NO_DATE, in_months, month_of
from granero.operators.ranking import global_ntile
from granero.plans import gold
from granero.plans.lake import Lake
from granero.plans.measures import SKETCH_ERROR, Star, measures_by_sets, merged_sketches, sketched_parts
from granero.plans.refresh import Run, read_sales, refresh
from granero.session import scratch_path
from granero.sources import retail
from granero.sources.tables import (
    Layers, live_paths, overwrite_slices, put_batch, read_reconciled, read_table, reconciled, save_bucketed, table_exists, widest,
)

from tests.conftest import plan, rows


def day(n):
    return dt.date(2001, 1, 1) + dt.timedelta(days=n)


# ------------------------------------------------------------ months
def test_months_of_dates(spark):
    df = spark.createDataFrame([(i, None if i % 7 == 3 else day(i)) for i in range(120)], "id int, d date")
    kept = df.withColumn("m", month_of("d"))
    assert rows(kept.select("m").distinct()) == [(NO_DATE,), *[(dt.date(2001, m, 1),) for m in range(1, 5)]]
    for wanted in ([dt.date(2001, 2, 1)], [dt.date(2001, 1, 1), dt.date(2001, 4, 1)], [NO_DATE], [NO_DATE, dt.date(2001, 3, 1)], []):
        expected = kept.where(F.col("m").isin(*wanted)) if wanted else kept.limit(0)
        assert rows(df.where(in_months("d", wanted)), "id") == rows(expected, "id")


def test_overwriting_slices_leaves_others_and_removes_empty_ones(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(i, day(i)) for i in range(90)], "id int, d date").withColumn("_mes", month_of("d"))
    overwrite_slices(df, path, "_mes")
    february = [dt.date(2001, 2, 1)]
    overwrite_slices(df.where("d < '2001-02-01' AND false"), path, "_mes", february)
    assert rows(read_table(spark, path).select("_mes").distinct()) == [(dt.date(2001, 1, 1),), (dt.date(2001, 3, 1),)]
    overwrite_slices(df.where("month(d) = 2").withColumn("id", -F.col("id")), path, "_mes", february)
    assert read_table(spark, path).where("id < 0").count() == 28 and read_table(spark, path).count() == 90
    overwrite_slices(df.where("month(d) = 1"), path, "_mes")
    assert read_table(spark, path).count() == 31 and table_exists(spark, path)


@pytest.fixture(scope="module")
def lake(spark, small, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    layers = Layers(str(root))
    sources = {name: lambda name=name: retail.source(spark, small, name) for name in TABLES}
    refresh(spark, layers, sources, Run(retail.AS_OF, "2002-01-01 02:00:00", "lote-1", "retail"))
    return layers


@pytest.mark.parametrize("days, months", [(14, 1), (90, 4), (180, 7)])
def test_trailing_windows_open_only_their_months(spark, lake, days, months):
    ref = F.lit("2001-08-01").cast("date")
    sales = read_sales(spark, lake, F.date_sub(ref, days))
    frames = {14: gold.trailing_consumption(sales, ref), 90: gold.rfm_base(sales, ref), 180: gold.active_members(sales, ref)}
    text = plan(frames[days])
    assert re.search(r"PartitionFilters: \[.*_mes.* >= 2001-0\d-01", text), text
    read = re.search(r"ReadSchema: struct<(.*)>", text)[1]
    assert "hra_trans" not in read and "tipo_pago" not in read
    files = sales.select(F.input_file_name()).distinct().count()
    everything = read_sales(spark, lake).select(F.input_file_name()).distinct().count()
    assert files <= 2 * (months + 1) < everything


def test_a_second_run_without_news_keeps_the_facts(spark, small, lake):
    import os

    def files(table):
        found = {}
        for folder, _, names in os.walk(lake.path("gold", table)):
            found.update({os.path.join(folder, n): os.stat(os.path.join(folder, n)).st_mtime_ns for n in names if n.endswith("parquet")})
        return found

    before = files("fact_ventas"), files("agg_ventas_diarias")
    sources = {name: lambda name=name: retail.source(spark, small, name) for name in TABLES}
    refresh(spark, lake, sources, Run(retail.AS_OF, "2002-01-02 02:00:00", "lote-2", "retail"))
    after = files("fact_ventas"), files("agg_ventas_diarias")
    future = "_mes=2027"
    for old, new in zip(before, after, strict=True):
        assert old and {k: v for k, v in old.items() if future not in k} == {k: v for k, v in new.items() if future not in k}


# ------------------------------------------------------------ buckets
def test_bucketed_sales_do_not_move(spark):
    sales = spark.range(2000).select(F.col("id").alias("id_trans"), (F.col("id") % 7).cast("decimal(12,2)").alias("precio_unitario_venta"))
    returns = spark.range(500).select(
        F.col("id").alias("id_devolucion"), (F.col("id") * 5).alias("id_trans_origen"), *[
            F.lit(v).cast(t).alias(n)
            for n, v, t in (
                ("art_id", 1, "bigint"), ("id_tienda", 1, "bigint"), ("fec_devolucion", "2001-01-01", "date"), ("qty_devuelta", 1, "int"),
                ("motivo_cod", "OTRO", "string"), ("canal_devolucion", "WEB", "string"), ("estado_devolucion", "APROBADA", "string"),
                ("vr_reembolso", 1, "decimal(12,2)"),
            )
        ],
    )
    stored = save_bucketed(sales, "precios_prueba", scratch_path(spark, "precios"), "id_trans", 8)
    plain = rows(gold.fact_returns(returns, sales))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(gold.fact_returns(returns, stored), "simple")
        assert rows(gold.fact_returns(returns, stored)) == plain
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.sql("DROP TABLE precios_prueba")
    assert text.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in text


# ------------------------------------------------------------ ntile
@pytest.mark.parametrize("seed, n", [(1, 5), (2, 5), (3, 3), (4, 7), (5, 5)])
def test_ntile_from_counts_equals_the_window_function(spark, seed, n):
    """Heavy ties, nulls, fewer rows than buckets, values that all differ."""
    rnd = random.Random(seed)
    size = {3: 2, 4: 500}.get(seed, 60)
    data = [(i * 13 % 1009, rnd.choice([None, 1, 1, 1, 2, 3]), rnd.random() < 0.9, rnd.randrange(10**6) / 100) for i in range(size)]
    df = spark.createDataFrame(data, "id int, few int, b boolean, money double").withColumn("money", F.col("money").cast("decimal(14,2)"))
    df = df.withColumn("same", F.lit(7)).withColumn("id", F.col("id").cast("bigint"))
    got = global_ntile(df, n, {"A": ["few", "id"], "B": ["money", "id"], "C": ["same", "id"]})
    df.createOrReplaceTempView("ntile_prueba")
    windows = ", ".join(f"cast(ntile({n}) OVER (ORDER BY {v} NULLS FIRST, id) AS int) AS {k}" for k, v in (("A", "few"), ("B", "money"), ("C", "same")))
    assert rows(got) == rows(spark.sql(f"SELECT *, {windows} FROM ntile_prueba"))
    assert global_ntile(df.limit(0), n, {"A": ["few", "id"]}).count() == 0


def test_ntile_writes_the_table_once(spark, monkeypatch):
    from granero.operators import ranking

    names = []
    stage = ranking.stage
    monkeypatch.setattr(ranking, "stage", lambda df, name: names.append((name, df.count())) or stage(df, name))
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("a"), F.col("id").alias("b"))
    global_ntile(df, 5, {"A": ["a", "id"], "B": ["b", "id"]}).count()
    assert [n for n, _ in names].count("ntile") == 1
    assert dict(names)["ntile"] == 1000
    assert sum(size for _, size in names) <= 1000 + (3 + 1000) + (1000 + 4)  # and counts per value, and the rows of border values


# ------------------------------------------------------------ grains and sketches
@pytest.fixture(scope="module")
def star(spark):
    sales = spark.range(4000).select(
        F.col("id").alias("id_trans"), (F.col("id") % 5).alias("id_tienda"), (F.col("id") % 11).alias("art_id"),
        F.when(F.col("id") % 4 == 0, "WEB").otherwise("APP").alias("canal_venta"), F.lit(2).cast("decimal(12,2)").alias("vr_venta_neto"),
        F.lit(3).cast("decimal(12,2)").alias("vr_venta_bruto"), F.lit(1).cast("decimal(12,2)").alias("descuento_aplicado"),
        F.lit(1).alias("qty_vendida"), F.lit(True).alias("ind_descuento"), F.lit(day(1)).alias("fec_trans"),
    )
    stores = spark.createDataFrame([(0, "CO"), (1, "CO"), (2, "MX"), (3, None)], "id_tienda bigint, id_pais string")  # one is unknown, one blank
    return Star(sales, {"id_tienda": stores})


@pytest.mark.parametrize("unique", [False, True])
def test_subtotals_keep_blank_values_apart(star, unique):
    sets = [["id_pais", "canal_venta"], ["id_pais"], []]
    names = ["ventas_netas", "transacciones", "ticket_promedio"]
    got = {(r["id_pais"], r["canal_venta"], r["nivel"]): r for r in measures_by_sets(Star(star.sales, star.dims, unique), sets, names).collect()}
    assert got[None, None, 3]["transacciones"] == 4000  # the total
    assert got[None, None, 1]["transacciones"] == 1600  # stores without a country
    assert got["CO", None, 1]["transacciones"] == got["CO", "WEB", 0]["transacciones"] + got["CO", "APP", 0]["transacciones"] == 1600
    assert len(got) == 6 + 3 + 1 and all(r["ticket_promedio"] == 2.0 for r in got.values())


def test_subtotals_scan_the_sales_once(spark, small):
    lake = Lake(spark, small, staged=["trans_ventas"])
    text = plan(measures_by_sets(lake.star, [["id_pais", "canal_venta"], ["id_pais"], []], ["ventas_netas"]), "simple")
    assert len(re.findall(r"FileScan parquet \[.*qty_vendida", text)) == 1


def test_sketches_merge_and_stay_within_their_error(star):
    doubled = Star(star.sales.union(star.sales), star.dims)
    parts = sketched_parts(doubled, ["fec_trans", "id_tienda", "canal_venta"], ["_lineas"])
    for by in (["canal_venta"], ["id_tienda"], []):
        exact = {tuple(r[c] for c in by): r["n"] for r in star.sales.groupBy(*by).agg(F.count_distinct("id_trans").alias("n")).collect()}
        for r in merged_sketches(parts, by, ["_lineas"]).collect():
            n = exact[tuple(r[c] for c in by)]
            assert abs(r["transacciones_aprox"] - n) <= SKETCH_ERROR * n and r["_lineas"] == 2 * n


# ------------------------------------------------------------ counting without a second scan
def test_quality_report_derives_no_source_twice(spark, small):
    lake = Lake(spark, small, staged=["trans_ventas"], counted=True)
    text = plan(lake.quality(), "simple")
    assert len(re.findall(r"FileScan parquet \[.*l_partkey", text)) == 2  # stock pairs and returns; the sales were written
    assert len(re.findall(r"FileScan parquet \[.*c_custkey", text)) == 1


# ------------------------------------------------------------ schemas
def test_widest_and_reconciled_types():
    i, b, d = T.IntegerType(), T.LongType(), T.DecimalType(12, 2)
    assert widest(i, b) == b == widest(b, i) and widest(i, T.StringType()) is None
    assert widest(d, T.DecimalType(10, 4)) == T.DecimalType(14, 4) and widest(T.DecimalType(38, 0), T.DecimalType(38, 10)) is None
    assert widest(T.FloatType(), T.DoubleType()) == T.DoubleType()

    def schema(**types):
        return T.StructType([T.StructField(k, v) for k, v in types.items()])

    got = reconciled([schema(a=i, c=d), schema(a=b, x=i), schema(x=i, a=b)])
    assert [(f.name, f.dataType) for f in got] == [("a", b), ("c", d), ("x", i)]
    for old, new in ((b, i), (i, T.StringType()), (d, T.DecimalType(10, 2)), (d, T.DecimalType(12, 4)), (T.DoubleType(), T.FloatType())):
        with pytest.raises(ValueError, match="a was stored as"):
            reconciled([schema(a=old), schema(a=new)])


def test_three_generations_are_read_together(spark, tmp_path):
    path = str(tmp_path / "t")
    put_batch(spark.createDataFrame([(1, 5), (2, 6)], "id bigint, n int"), path, "g1")
    put_batch(spark.createDataFrame([(3, 7, "x")], "id bigint, n int, extra string"), path, "g2")
    put_batch(spark.createDataFrame([(4, 2**40)], "id bigint, n bigint"), path, "g3")
    got = read_reconciled(spark, path, ["g1", "g2", "g3"])
    assert got.dtypes == [("id", "bigint"), ("n", "bigint"), ("extra", "string")]
    assert rows(got) == [(1, 5, None), (2, 6, None), (3, 7, "x"), (4, 2**40, None)]
    assert "extra" not in re.findall(r"ReadSchema: (.*)", plan(got.select("n")))[1]
    put_batch(spark.createDataFrame([(5, "no")], "id bigint, n string"), path, "g4")
    with pytest.raises(ValueError, match="cannot become string"):
        read_reconciled(spark, path, ["g1", "g2", "g3", "g4"])
    assert len(live_paths(spark, path)) == 4
