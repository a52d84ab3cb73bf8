"""The layered run on the small tables: golden counts, accounting, second run."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from granero.catalog import RETURNS, SALES, SUPPLIERS, TABLES, reference_edges
from granero.plans.refresh import Run, read_bronze, read_gold, read_silver, refresh
from granero.sources import retail
from granero.sources.tables import Layers, read_table

from tests.conftest import rows

GOLD_ROWS = {
    "dim_productos": 200, "dim_tiendas": 10, "dim_clientes": 150, "dim_calendario": 2405, "fact_ventas": 5979,
    "fact_inventario": 1905, "fact_devoluciones": 1960, "fact_rfm_clientes": 60, "agg_ventas_diarias": 5846,
    "agg_tasa_devolucion": 24, "kpi_ventas_pais_canal": 20, "kpi_top_productos": 60, "kpi_ventas_semanales": 1499,
    "_resultados_dq": 8,
}


@pytest.fixture(scope="module")
def lake(spark, small, tmp_path_factory):
    """The lake after a first run over the sales up to the split date, and a second over all."""
    root = tmp_path_factory.mktemp("lake")
    layers = Layers(str(root))
    landed = {}
    for name in TABLES:
        retail.source(spark, small, name).write.parquet(f"{root}/landing/{name}")
        landed[name] = lambda name=name: spark.read.parquet(f"{root}/landing/{name}")
    early = {**landed, "trans_ventas": lambda: retail.first_batch(landed["trans_ventas"]())}
    first = refresh(spark, layers, early, Run(dt.date(2001, 1, 1), "2001-01-01 02:00:00", "lote-1", "retail")).collect()
    run = Run(retail.AS_OF, "2002-01-01 02:00:00", "lote-2", "retail", partitions={"kpi_ventas_semanales": ["anio"]})
    second = refresh(spark, layers, landed, run).collect()
    return layers, run, landed, first, second


def test_bronze_holds_every_source_row_once(spark, lake, small):
    layers, *_ = lake
    for name, spec in TABLES.items():
        bronze = read_bronze(spark, layers, spec)
        assert bronze.count() == retail.source(spark, small, name).count(), name
        assert bronze.select(spec.key).distinct().count() == bronze.count(), name


def test_log_and_alert(spark, lake):
    layers, *_ = lake
    log = read_table(spark, layers.path("bronze", "_log_ingesta"))
    assert log.count() == 14
    per_run = dict(rows(log.where("tabla = 'trans_ventas'"), "batch_id", "registros"))
    assert sum(per_run.values()) == 6006 and per_run["lote-1"] > per_run["lote-2"] > 0
    alerts = read_table(spark, layers.path("bronze", "_alertas_volumen"))
    assert rows(alerts, "batch_id", "es_anomalia") == [("lote-2", True)]


def test_gold_row_counts(spark, lake):
    layers, *_ = lake
    assert {t: read_gold(spark, layers, t).count() for t in GOLD_ROWS} == GOLD_ROWS


def test_quality_report_accounts_for_every_row(spark, lake):
    layers, *_ = lake
    report = read_table(spark, layers.path("silver", "_reporte_calidad"))
    assert report.where("entrada <> duplicados + rechazados + salida").count() == 0
    got = {r["tabla"]: (r["entrada"], r["duplicados"], r["rechazados"], r["salida"]) for r in report.collect()}
    assert got["trans_ventas"] == (6006, 6, 21, 5979)
    assert got["post_devoluciones"] == (1968, 0, 8, 1960)


def test_error_table(spark, lake):
    layers, *_ = lake
    errors = read_table(spark, layers.path("silver", "_errores"))
    assert errors.columns == ["tabla_origen", "id_registro", "motivo", "_ts_error"]
    assert errors.count() == errors.select("tabla_origen", "id_registro").distinct().count() == 29
    assert rows(errors.groupBy("motivo").count()) == [
        ("fecha_futura", 5), ("fk_invalida_art_id", 8), ("fk_invalida_id_trans_origen", 8), ("monto_no_positivo", 8),
    ]


def test_every_kept_child_has_its_parent(spark, lake):
    layers, *_ = lake
    for child, ref, parent in reference_edges():
        lost = read_silver(spark, layers, child).join(
            read_silver(spark, layers, parent).select(F.col(parent.key).alias("_pk")), F.col(ref.column) == F.col("_pk"), "left_anti"
        )
        assert lost.count() == 0, (child.name, ref.column)


def test_personal_data_is_hashed(spark, lake, small):
    layers, *_ = lake
    plain = retail.suppliers(spark, small).select("id_proveedor", F.sha2("razon_social", 256).alias("razon_social"))
    assert rows(read_silver(spark, layers, SUPPLIERS), "id_proveedor", "razon_social") == rows(plain)


def test_checks_and_report(spark, lake):
    layers, _, _, first, second = lake
    assert {r["estado"] for r in read_gold(spark, layers, "_resultados_dq").collect()} == {"PASS"}
    assert [r["seccion"] for r in first].count("volumen") == 0  # one run only: nothing to compare
    assert sorted({r["seccion"] for r in second}) == ["calidad", "ingesta", "verificacion", "volumen"]


def test_net_sales_agree_everywhere(spark, lake):
    layers, *_ = lake
    total = read_gold(spark, layers, "fact_ventas").agg(F.sum("vr_venta_neto").cast("double")).first()[0]
    for table in ("agg_ventas_diarias", "kpi_ventas_pais_canal", "kpi_ventas_semanales"):
        assert read_gold(spark, layers, table).agg(F.sum("ventas_netas")).first()[0] == pytest.approx(total)


def test_running_again_changes_nothing(spark, lake):
    layers, run, landed, *_ = lake
    tables = ("fact_ventas", "fact_rfm_clientes", "kpi_ventas_semanales")
    before = {t: rows(read_gold(spark, layers, t)) for t in tables}
    bronze = read_bronze(spark, layers, SALES).count()
    log = rows(read_table(spark, layers.path("bronze", "_log_ingesta")), "tabla", "batch_id", "registros")
    alerts = rows(read_table(spark, layers.path("bronze", "_alertas_volumen")))
    refresh(spark, layers, landed, run)
    assert read_bronze(spark, layers, SALES).count() == bronze
    assert read_silver(spark, layers, RETURNS).count() == 1960
    assert {t: rows(read_gold(spark, layers, t)) for t in before} == before
    assert rows(read_table(spark, layers.path("bronze", "_log_ingesta")), "tabla", "batch_id", "registros") == log
    assert rows(read_table(spark, layers.path("bronze", "_alertas_volumen"))) == alerts


def test_bad_keys_and_an_empty_source_do_not_stop_a_run(spark, small, lake, tmp_path):
    """Missing keys are rejected, copies counted, a table without rows stays readable; late rows are reported."""
    _, _, landed, *_ = lake
    layers = Layers(str(tmp_path / "lake"))
    suppliers = landed["mstr_proveedores"]()
    lost = suppliers.limit(2).withColumn("id_proveedor", F.lit(None).cast("bigint"))
    sources = {
        **landed,
        "mstr_proveedores": lambda: suppliers.unionByName(lost).unionByName(suppliers.where("id_proveedor <= 3")),
        "post_devoluciones": lambda: landed["post_devoluciones"]().limit(0),
    }
    refresh(spark, layers, sources, Run(retail.AS_OF, "2002-01-01 02:00:00", "lote-1", "retail"))
    report = {r["tabla"]: r for r in read_table(spark, layers.path("silver", "_reporte_calidad")).collect()}
    n = suppliers.count()
    got = report["mstr_proveedores"]
    assert (got["entrada"], got["duplicados"], got["rechazados"], got["salida"]) == (n + 5, 3, 2, n)
    errors = read_table(spark, layers.path("silver", "_errores")).where("motivo = 'pk_nula'")
    assert rows(errors, "tabla_origen", "id_registro") == [("mstr_proveedores", None)] * 2
    assert read_gold(spark, layers, "fact_devoluciones").count() == 0

    late = {**sources, "post_devoluciones": landed["post_devoluciones"]}
    gone = landed["trans_ventas"]().where("canal_venta <> 'APP'")
    first = Layers(str(tmp_path / "late"))
    refresh(spark, first, {**late, "trans_ventas": lambda: gone}, Run(retail.AS_OF, "2002-01-01 02:00:00", "lote-1", "retail"))
    refresh(spark, first, late, Run(retail.AS_OF, "2002-01-02 02:00:00", "lote-2", "retail"))
    skipped = read_table(spark, first.path("bronze", "_filas_tardias")).where("batch_id = 'lote-2' AND tabla = 'trans_ventas'")
    expected = landed["trans_ventas"]().where("canal_venta = 'APP'").count()
    assert 0.9 * expected <= skipped.first()["tardias"] <= expected
