"""Cut lineage by writing a table to the shared checkpoint folder.

Used when the same expensive intermediate (the cleaned fact table) feeds many
queries: it is written once as Parquet under ``spark.checkpoint.dir`` and read
back, so later queries get column pruning and predicate pushdown and a lost
executor only recomputes from the written files, not from the raw join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path


def write_and_reread(spark: SparkSession, df: DataFrame, name: str, path: str | None = None, group_rows: int | None = None) -> DataFrame:
    target = path or scratch_path(spark, name)
    writer = df.write.mode("overwrite")
    if group_rows is not None:
        writer = writer.option("parquet.block.row.count.limit", group_rows)
    writer.parquet(target)
    return spark.read.parquet(target)
