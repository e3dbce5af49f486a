"""Connected components of a link table, in Spark.

Alternating large-star and small-star steps (Kiveris et al., 2014): each step
hangs neighbours on the smallest node known, until every component is a star.
Minima are pre-aggregated per task and written before they are joined, so a
node with very many links is split by Spark and is gathered nowhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import settled


def _smallest(links: DataFrame) -> DataFrame:
    """(a, low) per node a: the smallest of it and its neighbours b."""
    low = links.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("__a"), F.least("a", "low").alias("low"))
    return settled(low, "component_minima")


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a BIGINT, b BIGINT); the label is the smallest node reachable.

    Links to itself and repeated links do no harm; a null on either side is no
    link; without links the result is empty.
    """
    now = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = settled(now, "component_links")
    state = _state(now)
    while True:
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = _smallest(both)
        large = both.where("b > a").join(low, F.col("a") == F.col("__a")).select(F.col("b").alias("a"), F.col("low").alias("b"))
        low = _smallest(large)
        small = large.join(low, F.col("a") == F.col("__a")).select(
            F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("low").alias("b")), F.struct("a", F.col("low").alias("b")))).alias("x")
        ).select("x.*").where("a <> b").distinct()
        now = settled(small, "component_links")
        before, state = state, _state(now)
        if before == state:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionAll(
        now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    )
