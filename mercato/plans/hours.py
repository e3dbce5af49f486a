"""Activity by hour of day and by day part.

The fact table is aggregated once to at most 24 rows (distinct invoices are
planned by Spark as a two-step aggregate on (hour, Invoice), so a busy hour is
spread over many tasks); day parts and the peak are computed from those rows.
Day-part invoices are the **sum of hourly distinct counts**: an invoice with
lines in two hours counts in both.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.classify import before_paren, day_part
from ..functions.money import units_to_money
from ..operators.ranking import max_over_all
from .rollup import revenue


def hourly(sales_df: DataFrame) -> DataFrame:
    """hour, distinct invoices, revenue (exact units), units sold, day part."""
    h = sales_df.groupBy(F.hour("InvoiceDate").alias("hour")).agg(
        F.countDistinct("Invoice").alias("invoices"),
        revenue(sales_df).alias("revenue_units"),
        F.sum("Quantity").alias("units"),
    )
    return h.select("*", day_part("hour").alias("day_part"))


def hourly_activity(sales_df: DataFrame) -> DataFrame:
    h = hourly(sales_df)
    return h.select(
        "hour",
        "invoices",
        units_to_money("revenue_units").alias("revenue"),
        "units",
        "day_part",
        (F.col("invoices") == max_over_all("invoices")).alias("is_peak"),
    ).orderBy("hour")


def day_part_summary(sales_df: DataFrame) -> DataFrame:
    return (
        hourly(sales_df)
        .groupBy("day_part")
        .agg(F.sum("invoices").alias("invoices"), units_to_money(F.sum("revenue_units")).alias("revenue"))
        .orderBy(F.col("invoices").desc(), "day_part")
    )


def peak_hour(sales_df: DataFrame) -> DataFrame:
    """The hour with most distinct invoices (earliest hour wins a tie), its day
    part (full and short label), its invoices, and how many of the hours
    present have no invoice at all."""
    h = hourly(sales_df)
    order = F.col("invoices") * 24 + (23 - F.col("hour"))  # one number: more invoices first, then the earlier hour
    agg = h.agg(
        F.max_by("hour", order).alias("hour"),
        F.max("invoices").alias("invoices"),
        F.count_if(F.col("invoices") == 0).alias("inactive_hours"),
        F.count(F.lit(1)).alias("hours"),
    ).filter(F.col("hours") > 0)
    part = day_part("hour")
    return agg.select("hour", part.alias("day_part"), before_paren(part).alias("day_part_short"), "invoices", "inactive_hours")
