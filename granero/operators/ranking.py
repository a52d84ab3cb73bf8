"""Top-N per group, group mode, and ranks over a whole table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from granero.session import stage

_LOCAL_BITS = 33  # monotonically_increasing_id: partition number above, row number below


def top_n(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """First ``n`` rows of each group, numbered. Each task keeps at most ``n`` before the shuffle."""
    numbered = df.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return numbered.where(F.col(rank) <= n)


def group_mode(df: DataFrame, by: str, value: str, out: str) -> DataFrame:
    """Most frequent non-null value of each group; the smallest value wins a tie."""
    counts = df.where(F.col(value).isNotNull()).groupBy(by, value).agg(F.count("*").alias("_n"))
    best = F.min_by(value, F.struct((-F.col("_n")).alias("n"), F.col(value).alias("v")))
    return counts.groupBy(by).agg(best.alias(out))


def _starts(sizes: DataFrame, part: str, size: str) -> DataFrame:
    """Rows before each range partition, and the total. One row per partition."""
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(
        part,
        F.coalesce(F.sum(size).over(before), F.lit(0)).cast("bigint").alias("_antes"),
        F.sum(size).over(Window.orderBy(part).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        .cast("bigint")
        .alias("_total"),
    )


def number_rows(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Global 1-based position ``_pos`` in ``order``, and the row count ``_total``.

    ``order`` has to end in a unique column. Rows are range partitioned and
    sorted where they are, so no task sees the whole table and equal leading
    values are split by the unique column. The sorted rows are written before
    they are read twice: range bounds are sampled, and a second evaluation might
    draw other ones.
    """
    ranged = stage(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_mid", F.monotonically_increasing_id()),
        "ranged",
    )
    located = ranged.select(
        *df.columns,
        F.shiftright("_mid", _LOCAL_BITS).alias("_parte"),
        F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)).alias("_fila"),
    )
    sizes = located.groupBy("_parte").agg(F.count("*").alias("_n"))
    starts = F.broadcast(_starts(sizes, "_parte", "_n"))  # at most one row per partition
    return located.join(starts, "_parte").select(*df.columns, (F.col("_antes") + F.col("_fila") + 1).alias("_pos"), "_total")


def bucket_of(pos: Column, total: Column, n: int) -> Column:
    """``ntile(n)`` from a position: the first ``total % n`` buckets hold one row more."""
    small, larger = F.floor(total / F.lit(n)), total % n
    head = larger * (small + 1)
    in_head = F.ceil(pos / (small + 1))
    in_tail = larger + F.ceil(F.try_divide(pos - head, small))
    return F.when(pos <= head, in_head).otherwise(in_tail).cast("int")


def _running(counts: DataFrame, order: Sequence[str], size: str) -> DataFrame:
    """``counts`` with the rows before each of its values, ``_antes``, and all rows, ``_total``, in ``order``."""
    ranged = stage(counts.repartitionByRange(*order).withColumn("_parte", F.spark_partition_id()), "ranged")
    sizes = ranged.groupBy("_parte").agg(F.sum(size).alias("_n"))
    starts = F.broadcast(_starts(sizes, "_parte", "_n"))  # at most one row per partition
    here = Window.partitionBy("_parte").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum(size).over(here), F.lit(0))
    located = ranged.withColumn("_dentro", within).join(starts, "_parte")
    return located.select(*counts.columns, (F.col("_antes") + F.col("_dentro")).alias("_antes"), "_total")


def ntile_cuts(df: DataFrame, n: int, values: Sequence[str], key: str) -> dict[str, list[tuple]]:
    """Per column the last (value, key) of the first n - 1 buckets of ``ntile(n)`` over (value, key), nulls first.

    Rows are counted per distinct value, for all columns at once, and running
    totals tell in which value a bucket ends. Only the rows with these values,
    at most n - 1 for each column, are put in the order of the unique ``key``.
    What comes back is n - 1 rows per column.
    """
    kind = "decimal(38,6)"
    each = F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col(v).cast(kind).alias("v")) for i, v in enumerate(values)]))
    long = df.select(key, each.alias("_x")).select(
        F.col("_x.c").alias("c"), F.col("_x.v").isNotNull().alias("known"), F.coalesce("_x.v", F.lit(0).cast(kind)).alias("v"), key
    )
    counts = long.groupBy("c", "known", "v").agg(F.count(F.lit(1)).alias("size"))
    total = F.floor(F.col("_total") / len(values))
    before = F.col("_antes") - F.col("c") * total
    small, larger = F.floor(total / n), total % n
    k = F.explode(F.sequence(F.lit(1), F.lit(n - 1)))
    ends = _running(counts, ["c", "known", "v"], "size").withColumns({"_small": small, "_larger": larger, "_before": before})
    ends = ends.withColumn("k", k).withColumn("_at", F.col("k") * F.col("_small") + F.least("k", "_larger") - F.col("_before"))
    found = ends.where((F.col("_at") > 0) & (F.col("_at") <= F.col("size"))).select("c", "known", "v", "k", "_at").collect()
    if not found:
        return {v: [] for v in values}
    on_border = [(F.col("c") == r["c"]) & (F.col("known") == r["known"]) & (F.col("v") == F.lit(r["v"]).cast(kind)) for r in found]
    border = number_rows(long.where(reduce(or_, on_border)), ["c", "known", "v", key]).drop("_total")
    firsts = F.broadcast(border.groupBy("c", "known", "v").agg(F.min("_pos").alias("_first")))  # one row per border value
    nth = border.join(firsts, ["c", "known", "v"]).withColumn("_nth", F.col("_pos") - F.col("_first") + 1)
    wanted = [hit & (F.col("_nth") == r["_at"]) for hit, r in zip(on_border, found, strict=True)]
    at = {(r["c"], r["known"], r["v"], r["_nth"]): r[key] for r in nth.where(reduce(or_, wanted)).collect()}
    cuts = [(r["c"], r["k"], r["known"], r["v"], at[r["c"], r["known"], r["v"], r["_at"]]) for r in found]
    return {v: [cut[2:] for cut in sorted(cuts, key=lambda x: x[1]) if cut[0] == i] for i, v in enumerate(values)}


def bucket_by_cuts(value: str, key: str, cuts: Sequence[tuple]) -> Column:
    """The bucket of a row: one more than there are cuts before it."""
    kind = "decimal(38,6)"
    known, at = F.col(value).isNotNull(), F.coalesce(F.col(value).cast(kind), F.lit(0).cast(kind))
    bucket = F.lit(1)
    for is_known, v, k in cuts:
        limit = F.lit(v).cast(kind)
        same = known if is_known else ~known
        beyond = (at > limit) | ((at == limit) & (F.col(key) > F.lit(k)))
        later = (same & beyond) if is_known else (known | (same & beyond))
        bucket = bucket + later.cast("int")
    return bucket.cast("int")


def global_ntile(df: DataFrame, n: int, scores: Mapping[str, Sequence[str]]) -> DataFrame:
    """Exact ``ntile(n)`` over the whole table for several orderings, each a numeric column and then a unique key.

    The table is written once. Its buckets end at n - 1 rows per ordering
    (:func:`ntile_cuts`); with these as literals every row finds its buckets by
    itself, so no row is sorted or joined for that.
    """
    keys = {order[-1] for order in scores.values()}
    if len(keys) != 1 or any(len(order) != 2 for order in scores.values()):
        raise ValueError("each ordering is a column and the key, which all have in common")
    (key,) = keys
    df = stage(df, "ntile")
    cuts = ntile_cuts(df, n, [order[0] for order in scores.values()], key)
    return df.select("*", *[bucket_by_cuts(order[0], key, cuts[order[0]]).alias(name) for name, order in scores.items()])


def exact_quantiles(df: DataFrame, col: str, probs: Mapping[str, float]) -> DataFrame:
    """One row of linearly interpolated quantiles of the non-null values.

    Works on the count of each distinct value, running totals being kept per
    range partition and shifted by what lies before it.
    """
    counts = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("_v")).agg(F.count("*").alias("_n"))
    cumulative = _running(counts, ["_v"], "_n")
    last = F.col("_antes") + F.col("_n")  # rows up to and including this value
    wanted = []
    for name, p in probs.items():
        at = (F.col("_total") - 1) * F.lit(float(p))
        low, high = F.floor(at), F.ceil(at)
        value = F.col("_v").cast("double")

        def pick(i: Column) -> Column:
            return F.max(F.when((last - F.col("_n") <= i) & (i < last), value))

        lower, upper, weight = pick(low), pick(high), F.max(at - low)
        wanted.append((lower + (upper - lower) * weight).alias(name))
    return cumulative.agg(*wanted)
