"""Exact quantile with bounded per-task state.

Spark's ``percentile`` is exact but merges every distinct value of the group
in one task. This operator computes the same value (linear interpolation
between the two closest ranks, as ``percentile``, pandas ``quantile`` and
DuckDB ``quantile_cont``) as a distributed job:

1. value histogram: ``groupBy(value).sum(weight)`` (partial aggregation per
   task, so a value holding a third of the rows sends one row per task);
2. every value has a bucket, a monotone function of the value alone (its binary
   order of magnitude, cut into ``BUCKETS_PER_OCTAVE``), so the answer depends
   on no sampling, partition number or optimizer rule;
3. bucket totals (one row per bucket) -> cumulative offsets -> the one or two
   buckets that hold the bracketing ranks;
4. running counts inside those buckets only, and interpolation.

No task ever holds more than one bucket of distinct values or the bucket totals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS_PER_OCTAVE = 256


def value_bucket(v: Column) -> Column:
    """Bucket number of a double; larger values never have a smaller one."""
    size = F.abs(v)
    octave = F.floor(F.log2(size))
    inside = F.floor((size / F.pow(F.lit(2.0), octave.cast("double")) - 1) * BUCKETS_PER_OCTAVE)
    # 2000 octaves up, so that every number is positive before the sign is put on it
    number = (octave + 2000) * BUCKETS_PER_OCTAVE + inside
    big = F.lit(5000 * BUCKETS_PER_OCTAVE).cast("bigint")
    number = F.when(size == float("inf"), big).when(size < 1e-300, F.lit(1).cast("bigint")).otherwise(number)
    return F.when(v > 0, number).when(v < 0, -number).otherwise(F.lit(0).cast("bigint"))


def exact_quantile(df: DataFrame, col: str, q: float, weight: str | None = None) -> DataFrame:
    """One row, column ``quantile``: the exact ``q`` quantile of ``col``
    (NULLs ignored; NULL when there are no values). ``weight`` is an optional
    integral frequency column."""
    if not 0.0 <= q <= 1.0:
        raise ValueError("q must be in [0, 1]")
    w = F.col(weight) if weight else F.lit(1)
    # Missing values weigh nothing and lie in a bucket of their own. Filtering them out instead would be pushed
    # into only one of the two uses of the histogram, and it would be scanned for each.
    v = F.col("_v")
    hist = df.groupBy(F.col(col).cast("double").alias("_v")).agg(F.sum(w).cast("bigint").alias("_s")).select(
        "_v",
        F.when(v.isNull() | F.col("_s").isNull(), F.lit(0).cast("bigint")).otherwise(F.col("_s")).alias("_w"),
        F.coalesce(value_bucket(v), F.lit(-(1 << 62))).alias("_b"),
    )
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = hist.groupBy("_b").agg(F.sum("_w").alias("_bw")).select(
        F.col("_b").alias("_bucket"),
        "_bw",
        F.coalesce(F.sum("_bw").over(before), F.lit(0)).alias("_off"),
        F.sum("_bw").over(Window.partitionBy()).alias("_n"),
    )
    pos = (F.col("_n") - 1) * F.lit(q)
    lo, hi = F.floor(pos), F.ceil(pos)
    # two buckets at most hold the two ranks, so they are safe to broadcast
    chosen = offsets.filter((F.col("_off") <= hi) & (F.col("_off") + F.col("_bw") > lo))
    inside = Window.partitionBy("_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    j = hist.join(F.broadcast(chosen), F.col("_b") == F.col("_bucket")).withColumn("_cum", F.sum("_w").over(inside))
    first = F.col("_off") + F.col("_cum") - F.col("_w")  # 0-based rank of the first copy
    last = F.col("_off") + F.col("_cum") - 1

    def holds(rank: Column) -> Column:
        return (first <= rank) & (rank <= last)

    picked = j.agg(
        F.max(F.when(holds(lo), F.col("_v"))).alias("_lo_v"),
        F.max(F.when(holds(hi), F.col("_v"))).alias("_hi_v"),
        F.max(pos - lo).alias("_frac"),
    )
    lo_v, hi_v, frac = F.col("_lo_v"), F.col("_hi_v"), F.col("_frac")
    value = F.when(hi_v == lo_v, lo_v).otherwise(lo_v + (hi_v - lo_v) * frac)
    return picked.select(value.cast("double").alias("quantile"))
