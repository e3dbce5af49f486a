"""Reusable DataFrame operators: joins with literal dimensions, top-k and
ordered windows over aggregated rows, an exact distributed quantile, column
profiling, materialisation."""

from .joins import present_members
from .materialize import write_and_reread
from .profile import describe_columns, null_counts
from .quantile import exact_quantile
from .ranking import (
    max_over_all,
    over_all,
    position,
    rows_over_all,
    running_sum,
    top_k,
    total_over_all,
)

__all__ = [
    "present_members",
    "write_and_reread",
    "describe_columns",
    "exact_quantile",
    "null_counts",
    "max_over_all",
    "over_all",
    "position",
    "rows_over_all",
    "running_sum",
    "top_k",
    "total_over_all",
]
