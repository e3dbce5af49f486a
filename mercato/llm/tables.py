"""Intermediate tables under the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.materialize import write_and_reread


def settled(df: DataFrame, name: str, group_rows: int | None = None) -> DataFrame:
    """Write what an aggregation or join left and read it back.

    Such a table is much smaller than what was shuffled for it, so each task
    writes the partitions of several shuffle partitions, one after another,
    into one file: an eighth of the shuffle partitions, or two tasks for each
    core if that is more. With ``group_rows``, a row group of a file has at most
    so many rows: writers and readers hold a row group as a whole.
    """
    spark = df.sparkSession
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return write_and_reread(spark, df.coalesce(max(2 * spark.sparkContext.defaultParallelism, -(-shuffled // 8))), name, group_rows=group_rows)
