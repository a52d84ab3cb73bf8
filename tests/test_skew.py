"""One key holds a third of all rows or more; joins are forced to shuffle and to split."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from granero.catalog import SALES
from granero.operators import ingest, references
from granero.operators.dedup import deduplicate, first_per_key
from granero.operators.quarantine import error_summary, rejected, tag
from granero.plans.measures import Star, measures_by, same_day_last_week

from tests.conftest import rows

N = 30_000
FORCED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
}


@pytest.fixture(autouse=True)
def forced(spark):
    before = {k: spark.conf.get(k, None) for k in FORCED}
    for k, v in FORCED.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def hot(spark):
    """Half of the sales in store 1, a third of one article, a third anonymous, many copies."""
    n = F.col("id")
    return spark.range(N).select(
        n.alias("id_trans"),
        F.when(n % 3 != 0, n % 997).alias("id_miembro"),
        F.when(n % 2 == 0, 1).otherwise(n % 400).cast("bigint").alias("id_tienda"),
        F.when(n % 3 == 0, 10).otherwise(n % 300).cast("bigint").alias("art_id"),
        F.date_add(F.lit(dt.date(2001, 1, 1)), F.when(n % 3 == 0, 5).otherwise(n % 60).cast("int")).alias("fec_trans"),
        F.lit("09:00:00").alias("hra_trans"),
        (n % 7).cast("int").alias("qty_vendida"),
        F.when(n % 1000 == 7, -1).otherwise(n % 50 + 1).cast("decimal(12,2)").alias("precio_unitario_venta"),
        F.lit(None).cast("decimal(12,2)").alias("descuento_aplicado"),
        F.lit("PSE").alias("tipo_pago"),
        F.lit("WEB").alias("canal_venta"),
    )


def test_dedup(hot):
    df = hot.toPandas()
    want = df.sort_values("id_trans").drop_duplicates(list(SALES.business_key))
    got = deduplicate(hot, SALES).select("id_trans").toPandas()
    assert sorted(got["id_trans"]) == sorted(want["id_trans"])
    assert len(want) < N * 0.7


def test_latest_per_key(hot):
    got = first_per_key(hot, ["id_tienda"], [F.desc("fec_trans"), F.desc("id_trans")]).select("id_trans").toPandas()
    want = hot.toPandas().sort_values(["fec_trans", "id_trans"]).groupby("id_tienda").tail(1)
    assert sorted(got["id_trans"]) == sorted(want["id_trans"])


def test_reject_reasons(spark, hot):
    parents = {
        "mstr_tiendas": spark.range(0, 350).withColumnRenamed("id", "id_tienda"),
        "mstr_articulos": spark.range(0, 250).withColumnRenamed("id", "art_id"),
    }
    got = dict(rows(error_summary(rejected(tag(hot, SALES, dt.date(2001, 2, 25), parents), SALES)), "motivo", "registros"))
    df = hot.toPandas()
    bad = df["precio_unitario_venta"] <= 0
    late = ~bad & (df["fec_trans"] > dt.date(2001, 2, 25))
    store = ~bad & ~late & (df["id_tienda"] >= 350)
    art = ~bad & ~late & ~store & (df["art_id"] >= 250)
    assert got == {
        "monto_no_positivo": bad.sum(), "fecha_futura": late.sum(), "fk_invalida_id_tienda": store.sum(),
        "fk_invalida_art_id": art.sum(),
    }


def test_orphans_and_null_keys(spark, hot):
    members = spark.range(0, 900).withColumnRenamed("id", "id_miembro")
    df = hot.toPandas()
    lost = df["id_miembro"].isna() | (df["id_miembro"] >= 900)
    assert references.orphan_count(hot, "id_miembro", members, "id_miembro").first()[0] == lost.sum()
    assert references.orphans(hot, "id_miembro", members, "id_miembro").count() == lost.sum()
    assert references.resolved_or_null(hot, "id_miembro", members, "id_miembro").count() == (
        ~lost | df["id_miembro"].isna()
    ).sum()
    named = members.withColumn("nombre", F.col("id_miembro").cast("string"))
    joined = references.left_lookup(hot, named, "id_miembro", spread_nulls_by="id_trans")
    assert joined.count() == N and joined.where("nombre is null").count() == lost.sum()


def test_upsert(hot):
    changes = hot.where("id_trans % 3 = 0").withColumn("tipo_pago", F.lit("NEQUI"))
    merged = ingest.upsert(hot, changes, "id_trans")
    assert rows(merged.groupBy("tipo_pago").count()) == [("NEQUI", N // 3), ("PSE", N - N // 3)]


def test_measures(spark, hot):
    facts = hot.select(
        "*", (F.col("qty_vendida") * F.col("precio_unitario_venta")).cast("decimal(18,2)").alias("vr_venta_neto")
    )
    stores = spark.range(0, 400).select(F.col("id").alias("id_tienda"), (F.col("id") % 5).cast("string").alias("id_pais"))
    star = Star(facts, {"id_tienda": stores})
    df = facts.toPandas().assign(id_pais=lambda d: (d["id_tienda"] % 5).astype(str))
    want = df.groupby("id_pais").agg(neto=("vr_venta_neto", "sum"), n=("id_trans", "count"))
    expected = [(k, float(v.neto), int(v.n)) for k, v in want.iterrows()]
    for coarse in (True, False):
        assert rows(measures_by(star, ["id_pais"], ["ventas_netas", "transacciones"], coarse)) == expected

    daily = df.groupby("fec_trans")["vr_venta_neto"].sum().to_dict()
    for r in same_day_last_week(star).collect():
        before = daily.get(r["fecha"] - dt.timedelta(7))
        assert r["ventas_semana_anterior"] == (None if before is None else float(before))
