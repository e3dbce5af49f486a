"""Join helpers for dimensions that are literals of this library (their rows are written in the code)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def present_members(dim: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """Left-semi join: the rows of a literal dimension whose ``key`` occurs in ``facts``.

    Written as facts -> broadcast dimension -> distinct, so the large side is
    never shuffled row by row: the join runs map-side and the distinct is
    partially aggregated per partition before a shuffle of at most
    the dimension's rows per partition.
    """
    hit = facts.select(key).join(F.broadcast(dim.select(key)), on=key, how="left_semi")
    return dim.join(hit.distinct(), on=key, how="left_semi")
