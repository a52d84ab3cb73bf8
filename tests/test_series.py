"""Stock is derived from one row per pair: copies and references are judged on that row, days are generated afterwards."""

import datetime as dt
from dataclasses import replace

import pytest

from granero.catalog import STOCK, TABLES, Rule
from granero.operators.quarantine import rejected
from granero.plans import gold
from granero.plans.lake import Lake
from granero.plans.queries import QUERIES
from granero.plans.silver import cleaned
from granero.sources import retail

from tests.conftest import plan, rows


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    """Raw tables with copies of parts, a supplier that is unknown, pairs without a store and a part with two types."""
    folder = str(tmp_path_factory.mktemp("raw"))
    day = dt.datetime(2001, 5, 1)
    lines = [(o, o % 7 if o % 9 else None, o % 4, 1, 2.0, 3.0, 0.1, 0.0, "R", "O", day) for o in range(40)]
    tables = {
        "lineitem": (
            lines,
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double,"
            " l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
        ),
        "orders": (
            [(o, o % 5, day + dt.timedelta(o), "2-HIGH") for o in range(40)],
            "o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderpriority string",
        ),
        "part": (
            [(p, f"p{p}", f"Brand#{p % 3 + 1}", t, 5, 9.5) for p in range(6) for t in ["ECONOMY", "ECONOMY", "PROMO"][: p % 4]],
            "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
        ),
        "supplier": ([(s, f"s{s}", 1, 0.0) for s in (0, 1, 3)], "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        "nation": ([(n, f"n{n}", n) for n in range(4)], "n_nationkey int, n_name string, n_regionkey int"),
    }
    lines += [(100, 5, None, 1, 2.0, 3.0, 0.1, 0.0, "R", "O", day)]
    for name, (values, schema) in tables.items():
        spark.createDataFrame(values, schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_cleaned_series_are_the_cleaned_rows(spark, raw):
    for counted in (False, True):
        lake = Lake(spark, raw, counted=counted)
        parents = {ref.parent: lake.silver(ref.parent) for ref in STOCK.references}
        want = cleaned(retail.stock(spark, raw), STOCK, retail.AS_OF, parents, copies=lake.copies)
        got = lake._marked("inv_stock_diario")
        assert got.columns == want.columns and rows(got) == rows(want)
    reasons = {r[2] for r in rows(rejected(want, STOCK))}
    assert {"fk_invalida_id_tienda", "pk_nula"} <= reasons and want.where("_copias > 1").count()


def test_staged_series(spark, raw):
    plain, staged = Lake(spark, raw), Lake(spark, raw, staged=["inv_stock_diario"])
    assert rows(staged.silver("inv_stock_diario")) == rows(plain.silver("inv_stock_diario"))
    landed = retail.landed(spark, raw, "inv_stock_diario", "stock", ["id_snapshot", "art_id"])
    assert rows(landed) == rows(retail.stock(spark, raw), "id_snapshot", "art_id")


def test_newest_of_a_series(spark, raw):
    once = retail.stock_first_day(spark, raw).dropDuplicates(["id_snapshot"])
    each = gold.latest_snapshot(retail.stock_each_day(once))
    assert rows(gold.latest_snapshot(retail.stock_last_day(once))) == rows(each)


def test_generated_rows_do_not_move(spark, small):
    """Days are generated after the last shuffle (what runs last is printed first)."""
    text = plan(Lake(spark, small).tagged("inv_stock_diario"), "simple")
    assert text.index("Generate explode") < text.index("Exchange")
    assert "explode" not in plan(QUERIES["latest_snapshot"](spark, small), "simple")
    assert "distinct art_id" not in plan(QUERIES["snapshot_spine"](spark, small), "simple")


def test_landed_series_are_first_rows(spark, small):
    pairs = retail.stock_pairs(spark, small).count()
    landed = retail.landed(spark, small, "inv_stock_diario", "stock")
    assert landed.count() == 30 * pairs
    assert spark.read.parquet(*landed.inputFiles()).count() == pairs


def test_a_rule_on_a_daily_column_needs_every_row(spark, raw, monkeypatch):

    spec = replace(STOCK, rules=(Rule("sin_stock", "stock_fisico", "stock_fisico = 0"),))
    monkeypatch.setitem(TABLES, STOCK.name, spec)
    lake = Lake(spark, raw)
    assert lake.tagged(STOCK.name).where("motivo = 'sin_stock'").count()
