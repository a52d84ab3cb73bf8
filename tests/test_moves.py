"""What is written and moved: staged columns, ids counted for several grains at once."""

import datetime as dt

import pytest
from pyspark.sql import Window, functions as F

from granero.catalog import STOCK, STORES
from granero.operators import dedup, references
from granero.operators.dedup import deduplicate
from granero.operators.ingest import newest, stamp
from granero.plans import lake, refresh
from granero.plans.measures import Star, measures_by_sets
from granero.plans.queries import QUERIES
from granero.sources import retail
from granero.sources.tables import Layers, put_batch, read_newest, read_table, settle

from tests.conftest import plan, rows


@pytest.fixture(scope="module")
def repeated(spark):
    """Sales whose ids repeat within cells, over cells and over countries; some have none."""
    n = F.col("id")
    return spark.range(600).select(
        F.when(n % 11 != 0, n % 37).alias("id_trans"),
        F.when(n % 5 != 0, (n % 3).cast("string")).alias("id_pais"),
        (n % 4).cast("string").alias("canal_venta"),
        F.when(n % 7 != 0, (n % 2).cast("string")).alias("categoria_n1"),
        F.lit(dt.date(2001, 1, 1)).alias("fec_trans"),
        (n % 5).cast("int").alias("qty_vendida"),
    )


def test_distinct_ids_of_several_grains(repeated):
    sets = [["id_pais", "canal_venta", "categoria_n1"], ["canal_venta"], ["categoria_n1", "id_pais"], []]
    by = ["id_pais", "canal_venta", "categoria_n1"]
    got = measures_by_sets(Star(repeated, {}), sets, ["unidades", "transacciones"])
    df, want = repeated.toPandas(), set()
    for s in sets:
        level = sum(1 << (2 - by.index(c)) for c in by if c not in s)
        for key, rows in df.groupby(s, dropna=False) if s else [((), df)]:
            named = {c: None if v != v else v for c, v in zip(s, key, strict=True)}
            want.add((*[named.get(c) for c in by], level, int(rows["qty_vendida"].sum()), rows["id_trans"].nunique()))
    assert {tuple(r) for r in got.collect()} == want and got.count() == len(want)


def test_sales_move_once_for_all_grains(repeated):
    """What runs first is printed last: sales are summed to cells before these are repeated for every grain."""
    text = plan(measures_by_sets(Star(repeated, {}), [["id_pais", "canal_venta"], ["id_pais"], []], ["transacciones"]), "simple")
    assert text.count("hashpartitioning(id_trans") == 1 and "distinct id_trans" not in text
    assert text.index("Expand") < text.index("hashpartitioning(id_trans")


@pytest.mark.parametrize(
    "name, unused",
    [
        ("star_sales", ["hra_trans", "tipo_pago", "canal_venta"]),
        ("return_rate", ["id_miembro", "fec_trans", "precio_unitario_venta", "descuento_aplicado"]),
        ("return_ratio_overall", ["art_id", "fec_trans", "qty_vendida", "tipo_pago"]),
        ("transactions_sketched", ["id_miembro", "art_id", "tipo_pago"]),
        ("daily_trend", ["id_miembro", "art_id", "id_tienda", "tipo_pago"]),
        ("aggregates_by_month", ["id_miembro", "hra_trans", "tipo_pago"]),
        ("dq_checks", ["hra_trans", "tipo_pago", "canal_venta"]),
    ],
)
def test_only_columns_in_use_are_staged(spark, small, monkeypatch, name, unused):
    written = []

    def noted(frame, table):
        written.append((table, frame.columns))
        return staged(frame, table)

    staged = lake.stage
    monkeypatch.setattr(lake, "stage", noted)
    QUERIES[name](spark, small)
    sales = dict(written)["trans_ventas"]
    assert "id_trans" in sales and "motivo" in sales and not set(unused) & set(sales)


def test_copies_are_found_where_the_reference_is_checked(spark, small):
    stock = retail.stock(spark, small)
    twice = stock.unionByName(stock.where("id_snapshot % 3 = 0"))
    once = deduplicate(twice, STOCK, copies="n")
    assert "hashpartitioning(art_id" in plan(once, "simple") and "hashpartitioning(id_snapshot" not in plan(once, "simple")
    assert rows(once.groupBy("n").count()) == rows(stock.groupBy(((stock.id_snapshot % 3 == 0).cast("bigint") + 1).alias("n")).count())


def test_a_single_batch_is_not_ranked(spark, tmp_path):
    batch = stamp(spark.sql("select 1L id union all select 1L union all select null"), "2002-01-01 02:00:00", "x", "b1")
    path = str(tmp_path / "t")
    put_batch(batch, path, "b1")
    only = read_newest(spark, path, "id", batch.schema)
    assert rows(only, "id") == [(1,), (1,), (None,)] and "Window" not in plan(only, "simple")


def test_a_batch_is_stored_without_sorting_it(spark, small, tmp_path, monkeypatch):
    stored = []
    put = refresh.put_batch

    def noted(df, *args, **kwargs):
        stored.append(df)
        return put(df, *args, **kwargs)

    monkeypatch.setattr(refresh, "put_batch", noted)
    run = refresh.Run(retail.AS_OF, retail.RUN_TS, "b1", "x")
    got = refresh.ingest_table(spark, Layers(str(tmp_path)), STORES, lambda: retail.stores(spark, small), run)
    assert got["registros"] == retail.stores(spark, small).count()
    text = plan(stored[0], "simple")
    assert text.index("Project") < text.index("CollectMetrics")  # the stamps are on top, so their columns are constants


def test_dense_parents_are_checked_where_the_sales_are(spark, small):
    """The articles are too many to be broadcast as keys: 64 keys go in a row, so the sales are not moved by article."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4096")  # 200 articles here, so the limit is small too
    try:
        text = plan(QUERIES["silver_sales"](spark, small), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(art_id" not in text and "hashpartitioning(_palabra" not in text


def test_packed_keys_decide_like_keys(spark):
    """Negative, repeated, missing and far ids, on both sides; a null child matches nothing, with and without spreading."""
    parent = spark.sql("select explode(array(0, 1, 63, 64, 64, -1, -64, -65, 99999999, 9223372036854775807, null)) k")
    ids = "array(0, 1, 2, 62, 63, 64, 65, -1, -2, -64, -65, -66, 99999999, 99999998, 9223372036854775807, null, null)"
    child = spark.sql(f"select posexplode({ids}) as (n, k)").select("n", "k")
    for spread in (None, "n"):
        plain = references.with_match_flag(child, "k", parent, "k", "ok", spread)
        packed = references.with_match_flag(child, "k", references.packed_keys(parent, "k"), "k", "ok", spread)
        assert packed.columns == plain.columns and rows(packed, "n", "k", "ok") == rows(plain, "n", "k", "ok")


def test_lines_are_numbered_with_what_a_sale_holds(spark, small, tmp_path):
    """Columns that cannot tell two sales apart are not moved; lines that only differ by them give the same sales and returns."""
    sales, returns = (plan(t(spark, small), "simple") for t in (retail.sales, retail.returns))
    assert not any(c in sales for c in ("l_tax", "l_linestatus", "l_shipdate", "l_returnflag"))
    assert "l_tax" in returns and "l_shipdate" not in returns
    lines = spark.read.parquet(f"{small}/lineitem.parquet").where("l_orderkey < 40")
    marks = lines.withColumn("l_returnflag", F.lit("R")).withColumn("l_tax", F.col("l_tax") - 1)
    lines.unionByName(marks).unionByName(marks.withColumn("l_shipdate", F.lit(None).cast("timestamp_ntz"))).write.parquet(
        f"{tmp_path}/lineitem.parquet"
    )
    spark.read.parquet(f"{small}/orders.parquet").write.parquet(f"{tmp_path}/orders.parquet")
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag"]
    whole = Window.partitionBy("l_orderkey").orderBy(*order, "l_linestatus", "l_shipdate")
    numbered = spark.read.parquet(f"{tmp_path}/lineitem.parquet").withColumn("rn", F.row_number().over(whole))
    key = (F.col("l_orderkey") * 1_000_000 + F.col("rn")).alias("id")
    joined = numbered.join(spark.read.parquet(f"{tmp_path}/orders.parquet"), F.col("l_orderkey") == F.col("o_orderkey"))
    want = rows(joined.where("l_returnflag = 'R'").select(key, "l_partkey", "l_suppkey"))
    assert want and rows(retail.returns(spark, str(tmp_path)), "id_devolucion", "art_id", "id_tienda") == want
    assert rows(retail.sales(spark, str(tmp_path)).where("id_trans < 1000000000000000000"), "id_trans", "id_tienda") == rows(
        joined.select(key, "l_suppkey")
    )


def test_returns_move_once_to_their_sale(spark, small):
    """Copies are dropped where the sale and its price are looked up."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4096")
    try:
        text = plan(QUERIES["fact_returns"](spark, small), "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(id_devolucion" not in text and text.count("hashpartitioning(id_trans_origen") == 3


@pytest.mark.parametrize("name", ["sales_enriched", "agg_daily_sales"])
def test_stores_are_looked_up_where_the_sales_are(spark, small, name):
    """Their size is known when the join is planned, so it does not depend on which side is ready first."""
    text = plan(QUERIES[name](spark, small), "simple")
    assert "hashpartitioning(id_tienda" not in text


def test_settled_rows_stay_where_they_are(spark, tmp_path):
    """However many keys a batch brings: only those that are settled too make rows move."""
    path, plain = str(tmp_path / "t"), str(tmp_path / "plain")
    n = F.col("id")
    old = spark.range(3000).select(F.when(n % 50 != 0, n).alias("id"), (n % 7).alias("d"), F.lit("a").alias("v"))
    new = spark.range(2990, 6000).select(F.when(n % 40 != 0, n).alias("id"), (n % 7).alias("d"), F.lit("b").alias("v"))
    again = old.where("id % 2 = 1").unionByName(new.where("id % 3 = 1"))  # a key may come twice in a run
    first, second = stamp(old, "2002-01-01 02:00:00", "x", "b1"), stamp(again.unionByName(new), "2002-01-02 02:00:00", "x", "b2")
    few = stamp(new, "2002-01-02 02:00:00", "x", "b2")
    for batch, moved in ((few, False), (second, True)):
        for to in (path, plain):
            put_batch(first, f"{to}{moved}", "b1")
            put_batch(batch, f"{to}{moved}", "b2")
        settle(spark, f"{path}{moved}", "id", batch.schema, ["b2"])
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "2048")  # as with many more keys
        try:
            got = read_newest(spark, f"{path}{moved}", "id", batch.schema)
            text = plan(got, "simple")
            found = rows(got)
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert found == rows(newest(read_table(spark, f"{plain}{moved}", schema=batch.schema), "id"))
        assert moved or "SortMergeJoin" not in text


@pytest.mark.parametrize("keys", [40, 5000])
def test_copies_found_by_packed_keys_are_those_found_by_rows(spark, keys):
    n = F.xxhash64("id")
    rows_ = spark.range(600).select(F.when(F.pmod(n, F.lit(9)) > 0, n % keys).alias("k"), (F.pmod(n, F.lit(3))).alias("a"), F.lit("x").alias("b"))
    words = dedup.repeated_words(rows_, "k")
    assert 0 < words.count() and words.where("_repetida IS NULL").count() == 1
    got = dedup.drop_exact_among(rows_, "k", words, "n")
    assert rows(got) == rows(dedup.drop_exact(rows_, "n"))
    unique = spark.range(-100, 300, 3).select(F.col("id").alias("k"))
    assert dedup.repeated_words(unique, "k").count() == 0


@pytest.mark.parametrize("case, moved", [("unique", False), ("copies", False), ("many copies", True), ("two months", True)])
def test_stock_is_cleaned_where_it_is_stored(spark, small, tmp_path, monkeypatch, case, moved):
    """Whole rows of one month move neither for copies nor to be written; what is kept does not depend on it."""
    layers, noted = Layers(str(tmp_path)), []
    sources = {name: retail.source(spark, small, name) for name in ("mstr_articulos", "mstr_tiendas")}
    stock = retail.stock(spark, small).where("art_id % 20 = 1")
    again = stock.where("id_snapshot % 7 = 0")
    if case == "many copies":
        monkeypatch.setattr(refresh, "MOST_WORDS", 3, raising=False)
    if case in ("copies", "many copies"):
        stock = stock.unionByName(again).unionByName(again.withColumn("id_snapshot", F.lit(None).cast("bigint")))
    if case == "two months":
        stock = stock.withColumn("fec_snapshot", F.when(F.col("art_id") % 3 == 0, F.date_add("fec_snapshot", 31)).otherwise(F.col("fec_snapshot")))
    put_batch(stamp(stock, "2002-01-01 02:00:00", "retail", "lote-1"), layers.path("bronze", STOCK.name), "lote-1")
    for name, source in sources.items():
        marked = source.select("*", F.lit("valido").alias("_estado"), *[F.lit(None).cast(t).alias(c) for c, t in (("motivo", "string"), ("_ts_silver", "timestamp"), ("_copias", "bigint"))])
        marked.write.partitionBy("_estado").parquet(layers.path("silver", name))

    def written(df, *args, **options):
        noted.append(plan(df.hint("rebalance", "_mes") if options.get("gather", True) else df, "simple"))
        return store(df, *args, **options)

    store = refresh.overwrite_slices
    monkeypatch.setattr(refresh, "overwrite_slices", written)
    run = refresh.Run(retail.AS_OF, "2002-01-01 02:00:00", "lote-1", "retail")
    refresh._clean(spark, layers, STOCK, run, refresh.Progress(None), {})
    assert ("REBALANCE_PARTITIONS" in noted[0] or "hashpartitioning(art_id" in noted[0]) == moved
    kept = refresh._read_marked(spark, layers, STOCK)
    assert rows(kept.select(*STOCK.column_names, "_copias")) == rows(dedup.drop_exact(stock.select(*STOCK.column_names), "_copias"))
    assert kept.where("_estado = 'rechazado' AND motivo = 'pk_nula'").count() == kept.where("id_snapshot IS NULL").count()
    months = sorted(str(r[0]) for r in stock.select(F.trunc("fec_snapshot", "MM")).distinct().collect())
    assert sorted(str(r[0]) for r in kept.select("_mes").distinct().collect()) == months
