"""Monthly trend with moving mean and holiday flag; best and worst month.

One aggregate to one row per month, then windows over those rows only (the
number of months is bounded by the time span, not by the data volume).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.money import mean_money, units_to_money
from ..operators.ranking import over_all, position, rows_over_all
from ..schema import HOLIDAY_MONTHS_PATTERN, MOVING_AVERAGE_WIDTH
from .kpis import monthly_revenue
from .rollup import revenue
from .sales import month_index, month_text


def monthly_trend(sales_df: DataFrame, width: int = MOVING_AVERAGE_WIDTH) -> DataFrame:
    """YearMonth, revenue, distinct invoices, moving mean over the last
    ``width`` months present (rows, not calendar months; NULL unless there are
    at least ``width`` months), and whether the month is November/December."""
    m = monthly_revenue(sales_df)
    frame = over_all(["YearMonth"]).rowsBetween(-(width - 1), Window.currentRow)
    w = m.select(
        "*",
        F.sum("revenue_units").over(frame).alias("win_units"),
        F.count(F.lit(1)).over(frame).alias("win_months"),
        rows_over_all().alias("months"),
    )
    return w.select(
        "YearMonth",
        units_to_money("revenue_units").alias("revenue"),
        "invoices",
        F.when(F.col("months") >= width, mean_money("win_units", "win_months", 2)).alias("moving_avg"),
        F.col("YearMonth").rlike(HOLIDAY_MONTHS_PATTERN).alias("is_holiday"),
    ).orderBy("YearMonth")


def monthly_extremes(sales_df: DataFrame) -> DataFrame:
    """Best and worst month (the earlier month wins a tie) and their revenue."""
    months = sales_df.groupBy(month_index().alias("_m")).agg(revenue(sales_df).alias("u"))
    # the revenue as two BIGINT digits, most significant first, made once per month
    base = F.lit(10**18).cast("decimal(38,0)")
    high = F.call_function("div", F.col("u"), base)
    low = (F.col("u") - high.cast("decimal(38,0)") * base).cast("bigint")
    m = months.select("_m", "u", high.alias("_high"), low.alias("_low"))
    best = position([F.col("_high").desc(), F.col("_low").desc(), "_m"])
    worst = position([F.col("_high"), F.col("_low"), "_m"])
    ranked = m.select("_m", "u", best.alias("_best"), worst.alias("_worst"))
    first_best, first_worst = F.col("_best") == 1, F.col("_worst") == 1
    agg = ranked.agg(
        F.max(F.when(first_best, F.col("_m"))).alias("best"),
        F.max(F.when(first_best, F.col("u"))).alias("best_units"),
        F.max(F.when(first_worst, F.col("_m"))).alias("worst"),
        F.max(F.when(first_worst, F.col("u"))).alias("worst_units"),
    ).filter(F.col("best").isNotNull())
    return agg.select(
        month_text("best").alias("best_month"),
        units_to_money("best_units").alias("best_revenue"),
        month_text("worst").alias("worst_month"),
        units_to_money("worst_units").alias("worst_revenue"),
    )
