"""Column profiling: null counts and descriptive statistics.

Both are single-pass aggregates (partial aggregation per task, one tiny
shuffle), whatever the number of columns: all statistics of all columns are
computed in one ``agg`` and then unpivoted with ``inline``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row, one column per input column: how many values are NULL."""
    cols = columns or df.columns
    return df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in cols])


def describe_columns(df: DataFrame, columns: list[str] | None = None, digits: int = 6) -> DataFrame:
    """Per column: non-null count, mean, sample stddev, min and max (as text).

    Mean and stddev are NULL for non-numeric columns; booleans and timestamps
    are skipped, as ``DataFrame.describe`` does.
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    cols = [
        c
        for c in (columns or df.columns)
        if isinstance(fields[c], _NUMERIC) or isinstance(fields[c], T.StringType)
    ]
    aggs = []
    for i, c in enumerate(cols):
        col = F.col(f"`{c}`")
        numeric = isinstance(fields[c], _NUMERIC)
        aggs += [
            F.count(col).alias(f"n{i}"),
            (F.avg(col) if numeric else F.lit(None).cast("double")).alias(f"m{i}"),
            (F.stddev_samp(col) if numeric else F.lit(None).cast("double")).alias(f"s{i}"),
            F.min(col).cast("string").alias(f"lo{i}"),
            F.max(col).cast("string").alias(f"hi{i}"),
        ]
    stats = df.agg(*aggs)
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"n{i}").alias("count"),
                F.round(F.col(f"m{i}"), digits).alias("mean"),
                F.round(F.col(f"s{i}"), digits).alias("stddev"),
                F.col(f"lo{i}").alias("min"),
                F.col(f"hi{i}").alias("max"),
            )
            for i, c in enumerate(cols)
        ]
    )
    return stats.select(F.inline(rows))
