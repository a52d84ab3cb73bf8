import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from granero.operators import ranking
from granero.operators.ranking import bucket_of, exact_quantiles, global_ntile, group_mode, top_n

from tests.conftest import rows


@pytest.mark.parametrize("n", [0, 1, 3, 5, 7, 1003])
def test_global_ntile_equals_window_ntile(spark, n):
    rng = random.Random(n)
    df = spark.createDataFrame(
        [(i, rng.choice([0, 0, 0, 1, 2, 9]), rng.random()) for i in range(n)], "id bigint, tie int, v double"
    ).repartition(4)
    got = global_ntile(df, 5, {"A": ["tie", "id"], "B": ["v", "id"]})
    want = df.withColumn("A", F.ntile(5).over(Window.orderBy("tie", "id"))).withColumn(
        "B", F.ntile(5).over(Window.orderBy("v", "id"))
    )
    assert rows(got, "id", "A", "B") == rows(want, "id", "A", "B")
    sizes = [r["count"] for r in got.groupBy("A").count().collect()]
    assert not sizes or max(sizes) - min(sizes) <= 1


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(total=st.integers(1, 60), n=st.integers(1, 8))
def test_bucket_formula(spark, total, n):
    df = spark.range(1, total + 1).withColumn("t", F.lit(total).cast("bigint"))
    got = df.select("id", bucket_of(F.col("id"), F.col("t"), n).alias("b"))
    want = df.select("id", F.ntile(n).over(Window.orderBy("id")).alias("b"))
    assert rows(got) == rows(want)


def test_one_value_for_most_rows_is_spread_over_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(4000).select("id", F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1).alias("v"))
        numbered = ranking.number_rows(df, ["v", "id"])
        used = numbered.withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
        assert len(used) > 1 and max(r["count"] for r in used) < 2000
        pos = [r["_pos"] for r in numbered.orderBy("v", "id").collect()]
        assert pos == list(range(1, 4001))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_group_mode_ties_nulls_and_null_group(spark):
    df = spark.createDataFrame(
        [("a", "x"), ("a", "y"), ("a", "y"), ("b", "z"), ("b", "m"), ("c", None), (None, "q")], "g string, v string"
    )
    assert rows(group_mode(df, "g", "v", "m")) == [("a", "y"), ("b", "m"), (None, "q")]


def test_top_n_breaks_ties_by_the_last_key(spark):
    df = spark.createDataFrame([("g", i, 5.0 if i >= 9 else 10.0) for i in range(15)], "g string, id int, v double")
    got = top_n(df, ["g"], [F.desc("v"), F.asc("id")], 10)
    assert [r["id"] for r in got.orderBy("rank").collect()] == [0, 1, 2, 3, 4, 5, 6, 7, 8, 9]


@pytest.mark.parametrize("values", [[1], [1, 2], [3, 3, 3, 9], list(range(101)), [5.5, -2.0, None, 7.25, 7.25, 0.0]])
def test_exact_quantiles(spark, values):
    df = spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double").repartition(3)
    got = exact_quantiles(df, "v", {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p90": 0.9, "p100": 1.0}).first()
    clean = [v for v in values if v is not None]
    assert list(got) == pytest.approx(list(np.quantile(clean, [0, 0.25, 0.5, 0.9, 1.0])))


def test_exact_quantiles_without_rows(spark):
    assert exact_quantiles(spark.createDataFrame([], "v double"), "v", {"p": 0.5}).first()["p"] is None


def test_quantiles_like_describe(spark):
    values = np.random.default_rng(3).normal(size=500).round(2)
    df = spark.createDataFrame(pd.DataFrame({"v": values}))
    got = exact_quantiles(df, "v", {"p25": 0.25, "p50": 0.5, "p75": 0.75}).first()
    assert list(got) == pytest.approx(list(pd.Series(values).describe()[["25%", "50%", "75%"]]))
