import datetime as dt
from decimal import Decimal

import pytest

from granero.catalog import SALES, Reference, Rule, TableSpec, Column
from granero.operators import quarantine, references
from granero.operators.dedup import deduplicate, drop_exact, first_per_key
from pyspark.sql import functions as F, types as T

from tests.conftest import rows

AS_OF = dt.date(2002, 1, 1)
D = dt.date(2001, 5, 1)


def sales(spark, *changes):
    base = dict(
        id_trans=1, id_miembro=7, id_tienda=1, art_id=10, fec_trans=D, hra_trans="09:00:00", qty_vendida=2,
        precio_unitario_venta=Decimal("5.00"), descuento_aplicado=None, tipo_pago="PSE", canal_venta="WEB",
    )
    return spark.createDataFrame([{**base, **c} for c in changes], SALES.schema)


def keys(spark, name, *values):
    return spark.createDataFrame([(v,) for v in values], f"{name} bigint")


def parents(spark):
    return {"mstr_tiendas": keys(spark, "id_tienda", 1, 1, None), "mstr_articulos": keys(spark, "art_id", 10)}


def reasons(tagged):
    return dict(rows(tagged, "id_trans", "motivo"))


def test_business_key_keeps_smallest_id_and_null_members_are_equal(spark):
    df = sales(
        spark,
        dict(id_trans=5), dict(id_trans=3), dict(id_trans=3),
        dict(id_trans=9, id_miembro=None), dict(id_trans=8, id_miembro=None),
        dict(id_trans=4, hra_trans="10:00:00"),
    )
    assert rows(deduplicate(df, SALES), "id_trans") == [(3,), (4,), (8,)]


def test_same_id_and_key_with_other_content_is_chosen_the_same_way(spark):
    df = sales(spark, dict(qty_vendida=1), dict(qty_vendida=2), dict(qty_vendida=3))
    first = rows(deduplicate(df, SALES), "qty_vendida")
    shuffled = df.orderBy(F.desc("qty_vendida")).repartition(5)
    assert len(first) == 1 and rows(deduplicate(shuffled, SALES), "qty_vendida") == first


def test_drop_exact_and_empty(spark):
    df = sales(spark, {}, {}, dict(id_trans=2))
    assert drop_exact(df).count() == 2
    assert drop_exact(df.limit(0)).count() == 0
    assert deduplicate(df.limit(0), SALES).count() == 0


def test_first_reason_in_declared_order(spark):
    df = sales(
        spark,
        dict(id_trans=1),
        dict(id_trans=2, precio_unitario_venta=Decimal("-1.00"), fec_trans=dt.date(2027, 1, 1), art_id=99),
        dict(id_trans=3, fec_trans=dt.date(2027, 1, 1), art_id=99),
        dict(id_trans=4, art_id=99, id_tienda=5),
        dict(id_trans=5, art_id=99),
        dict(id_trans=6, art_id=None),
        dict(id_trans=7, fec_trans=AS_OF),
        dict(id_trans=8, precio_unitario_venta=Decimal("0.00")),
    )
    assert reasons(quarantine.tag(df, SALES, AS_OF, parents(spark))) == {
        1: None, 2: "monto_no_positivo", 3: "fecha_futura", 4: "fk_invalida_id_tienda", 5: "fk_invalida_art_id",
        6: "fk_invalida_art_id", 7: None, 8: "monto_no_positivo",
    }


def test_nulls_are_reported_or_left_out(spark):
    df = sales(
        spark, dict(id_trans=None), dict(id_trans=2, precio_unitario_venta=None), dict(id_trans=3, fec_trans=None),
        dict(id_trans=4),
    )
    assert reasons(quarantine.tag(df, SALES, AS_OF)) == {
        None: "pk_nula", 2: "null_precio_unitario_venta", 3: "null_fec_trans", 4: None,
    }
    assert reasons(quarantine.tag(df, SALES, AS_OF, report_nulls=False)) == {None: "pk_nula", 4: None}


def test_valid_and_rejected_split_the_rows(spark):
    df = sales(spark, dict(id_trans=1), dict(id_trans=2, precio_unitario_venta=Decimal("-1.00")))
    tagged = quarantine.tag(df, SALES, AS_OF)
    assert rows(quarantine.valid(tagged), "id_trans") == [(1,)]
    assert rows(quarantine.rejected(tagged, SALES)) == [("trans_ventas", "2", "monto_no_positivo")]
    assert rows(quarantine.error_summary(quarantine.rejected(tagged, SALES))) == [("trans_ventas", "monto_no_positivo", 1)]


def test_quality_row_accounts_for_every_row(spark):
    df = sales(spark, {}, {}, dict(id_trans=2, precio_unitario_venta=Decimal("-1.00"), hra_trans="11:00:00"))
    tagged = quarantine.tag(deduplicate(df, SALES), SALES, AS_OF)
    assert rows(quarantine.quality_row("t", df, tagged)) == [("t", 3, 1, 1, 1, 33.33)]
    empty = df.limit(0)
    assert rows(quarantine.quality_row("t", empty, quarantine.tag(empty, SALES, AS_OF))) == [("t", 0, 0, 0, 0, 0.0)]


def test_null_ok_reference(spark):
    spec = TableSpec(
        "hija", "id", (Column("id", T.LongType()), Column("fk", T.LongType(), nullable=True)),
        references=(Reference("fk", "mstr_tiendas", null_ok=True),),
    )
    df = spark.createDataFrame([(1, None), (2, 1), (3, 9)], "id bigint, fk bigint")
    tagged = quarantine.tag(df, spec, AS_OF, {"mstr_tiendas": keys(spark, "id_tienda", 1)})
    assert dict(rows(tagged, "id", "motivo")) == {1: None, 2: None, 3: "fk_invalida_fk"}


def test_reference_operators(spark):
    child = spark.createDataFrame([(1, 10), (2, 99), (3, None), (4, 99), (5, 10)], "id bigint, fk bigint")
    parent = keys(spark, "pk", 10, 10, 11, None)  # repeated and null parent keys must not multiply or match rows
    assert rows(references.orphans(child, "fk", parent, "pk"), "id") == [(2,), (3,), (4,)]
    assert rows(references.resolved(child, "fk", parent, "pk"), "id") == [(1,), (5,)]
    assert rows(references.resolved_or_null(child, "fk", parent, "pk"), "id") == [(1,), (3,), (5,)]
    assert references.orphan_count(child, "fk", parent, "pk").first()[0] == 3
    assert references.orphan_count(child.limit(0), "fk", parent, "pk").first()[0] == 0


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
def test_left_lookup_spreads_null_keys_without_matching_them(spark, broadcast):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        fact = spark.range(1000).select(
            F.col("id").alias("n"), F.when(F.col("id") % 3 != 0, F.col("id") % 50 - 25).alias("k")
        )
        dim = spark.range(-(1 << 20), 50, 1).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
        got = references.left_lookup(fact, dim, "k", spread_nulls_by="n")
        assert got.columns == ["n", "k", "v"]
        assert got.count() == 1000
        assert got.where("k is null and v is not null").count() == 0
        assert got.where("k is not null and (v is null or v <> 2 * k)").count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_custom_rule_order(spark):
    spec = TableSpec(
        "t", "id", (Column("id", T.LongType()), Column("x", T.IntegerType())),
        rules=(Rule("negativo", "x", "x < 0"), Rule("grande", "x", "x > 10")),
    )
    df = spark.createDataFrame([(1, -5), (2, 50), (3, 5)], "id bigint, x int")
    assert dict(rows(quarantine.tag(df, spec, AS_OF), "id", "motivo")) == {1: "negativo", 2: "grande", 3: None}


def test_first_per_key_orders(spark):
    df = spark.createDataFrame([(1, D, 5), (1, dt.date(2001, 6, 1), 4), (2, D, 1)], "k int, d date, v int")
    assert rows(first_per_key(df, ["k"], [F.desc("d")]), "k", "v") == [(1, 4), (2, 1)]
