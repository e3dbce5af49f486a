"""Query plans: the cleaning job, the typed/sales views and every report."""

from .catalog import Retail, dashboard_queries, queries, raw_queries
from .clean import clean
from .sales import sales, typed, with_time_attributes

__all__ = ["Retail", "dashboard_queries", "queries", "raw_queries", "clean", "sales", "typed", "with_time_attributes"]
