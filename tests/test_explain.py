"""Plans: what moves, what is pushed down, what must not happen."""

import re

import pytest
from pyspark.sql import functions as F

from granero.catalog import SALES
from granero.functions.dates import latest_date
from granero.operators import ingest, references
from granero.operators.dedup import deduplicate
from granero.plans import gold, kpis
from granero.plans.queries import QUERIES
from granero.plans.refresh import _audited
from granero.session import shared_dir, stage
from granero.sources import retail

from tests.conftest import plan


@pytest.fixture(scope="module")
def facts(spark, small):
    return stage(gold.fact_sales(retail.sales(spark, small)), "facts")


def test_dedup_limits_each_key_before_the_shuffle(spark, small):
    text = plan(deduplicate(retail.sales(spark, small), SALES), "simple")
    assert text.index("hashpartitioning(id_miembro") < text.index("row_number(), 1, Partial")


def test_only_needed_columns_and_days_are_read(facts):
    ref = F.lit("2001-08-01").cast("date")
    text = plan(gold.trailing_consumption(facts, ref))
    assert re.search(r"ReadSchema: struct<art_id:bigint,fec_trans:date,qty_vendida:int>", text)
    assert "GreaterThan(fec_trans,2001-07-18)" in text


def test_reference_date_reaches_the_scan(facts):
    text = plan(gold.rfm_base(facts, latest_date(facts, "fec_trans")))
    assert re.search(r"PushedFilters: \[.*GreaterThan\(fec_trans,\d{4}-", text)
    assert "Subquery" not in text and "Window" not in text


def test_watermark_reaches_the_scan(spark, facts):
    text = plan(ingest.increment(facts, facts.where("fec_trans < '2000-01-01'"), SALES))
    assert re.search(r"PushedFilters: \[.*GreaterThan\(fec_trans,1999-12-", text)


@pytest.mark.parametrize("name", ["rfm", "agg_rfm_segments"])
def test_quintiles_use_no_single_partition_window_over_members(spark, small, name):
    text = plan(QUERIES[name](spark, small), "simple")
    for line in re.findall(r"Window \[.*", text):
        assert "ntile" not in line and "_parte" in line  # only over one row per range partition


def test_coarse_measures_meet_the_dimension_after_summing(spark, facts, small):
    star = kpis.Star(facts, {"id_tienda": gold.dim_stores(retail.stores(spark, small))})
    text = plan(kpis.measures_by(star, ["id_pais"], ["ventas_netas"]), "simple")
    assert text.index("LeftOuter") < text.index("partial_sum(vr_venta_neto")  # what runs first is printed last


def test_orphan_count_joins_counts_not_rows(spark, facts, small):
    """With a parent too large to broadcast, child rows are counted per key before they meet it."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(references.orphan_count(facts, "art_id", retail.articles(spark, small), "art_id"), "simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert text.rindex("LeftAnti") < text.rindex("partial_count(1)")


def test_stage_uses_the_named_folder(spark, facts):
    assert facts.inputFiles()[0].startswith(("file://" + shared_dir(spark), shared_dir(spark)))


def test_bronze_schema_lists_audit_columns():
    assert _audited(SALES).fieldNames()[-6:] == [
        "_ts_ingesta", "_sistema_fuente", "_batch_id", "_anio_ingesta", "_mes_ingesta", "_dia_ingesta",
    ]
