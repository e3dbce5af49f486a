"""Top-k, arg-max and ordered windows over aggregated rows.

* ``top_k`` is ``orderBy(...).limit(n)``, which Spark plans as
  TakeOrderedAndProject: every task keeps its own best ``n`` and only
  ``n x tasks`` rows reach the final merge, never a global sort.
* Ties are broken by the group key so results do not depend on partitioning.
* The window helpers take **no partition key**; they are only ever applied to
  aggregated results whose row count is bounded by a small key domain
  (countries, months, hours), never to the fact table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def top_k(df: DataFrame, n: int, order: Sequence[str | Column], tie_break: Sequence[str | Column] = ()) -> DataFrame:
    return df.orderBy(*_cols(order), *_cols(tie_break)).limit(n)


def over_all(order: Sequence[str | Column] | None = None) -> Window:
    """An un-partitioned window, for small aggregated inputs only."""
    w = Window.partitionBy()
    return w.orderBy(*_cols(order)) if order else w


def running_sum(col: str | Column, order: Sequence[str | Column]) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c).over(over_all(order).rowsBetween(Window.unboundedPreceding, Window.currentRow))


def total_over_all(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c).over(over_all())


def max_over_all(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.max(c).over(over_all())


def rows_over_all() -> Column:
    return F.count(F.lit(1)).over(over_all())


def position(order: Sequence[str | Column]) -> Column:
    return F.row_number().over(over_all(order))
