"""Revenue by country: top countries, Pareto concentration.

The fact table is aggregated once to one row per country (partial
aggregation per task, so even a country holding most lines sends one row
per task through the shuffle). Everything after that — totals, ranks,
cumulative percent — runs on that small result with un-partitioned windows;
its size is bounded by the number of countries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.money import MONEY_SCALE, half_even_div, share, units_to_money
from ..functions.text import money_text, pct_text, thousands_text
from ..operators.ranking import over_all, running_sum, top_k
from ..schema import PARETO_THRESHOLD, PARETO_TOP_N
from .rollup import revenue


def revenue_by_country(sales_df: DataFrame) -> DataFrame:
    """Exact revenue units per country (missing countries dropped)."""
    return sales_df.filter(F.col("Country").isNotNull()).groupBy("Country").agg(revenue(sales_df).alias("revenue_units"))


def rank_order() -> list:
    """Revenue descending (exact units), then country: a total order."""
    return [F.col("revenue_units").desc(), F.col("Country")]


def top_countries(sales_df: DataFrame, n: int = 10) -> DataFrame:
    r = revenue_by_country(sales_df)
    return top_k(r, n, rank_order()).select("Country", units_to_money("revenue_units").alias("revenue"))


def country_ranking(sales_df: DataFrame) -> DataFrame:
    """Every country with rank, percent of total (2 dp, half-even) and the
    cumulative sum of those rounded percents (2 dp, half-even)."""
    r = revenue_by_country(sales_df)
    # rank and grand total share one window ordering: one Window operator
    w = over_all(rank_order())
    everything = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = r.select(
        "Country",
        "revenue_units",
        F.row_number().over(w).alias("rank"),
        F.sum("revenue_units").over(everything).alias("total_units"),
    ).select("*", F.bround(share("revenue_units", "total_units") * 100, 2).alias("pct"))
    return ranked.select("*", F.bround(running_sum("pct", ["rank"]), 2).alias("cum_pct"))


def country_pareto(sales_df: DataFrame, top_n: int = PARETO_TOP_N) -> DataFrame:
    """Top ``top_n`` countries: revenue, percent of all countries' revenue,
    cumulative percent and revenue in thousands (1 dp, half-even)."""
    ranking = country_ranking(sales_df).filter(F.col("rank") <= top_n)
    return ranking.select(
        "Country",
        units_to_money("revenue_units").alias("revenue"),
        "pct",
        "cum_pct",
        (half_even_div("revenue_units", F.lit(1000 * MONEY_SCALE // 10)) / 10.0).alias("revenue_k"),
        "rank",
    ).orderBy("rank").drop("rank")


def pareto_summary(
    sales_df: DataFrame, top_n: int = PARETO_TOP_N, threshold: float = PARETO_THRESHOLD
) -> DataFrame:
    """Share of the top N, countries and revenue in total, how many countries
    reach ``threshold`` percent (count of cumulative percents <= threshold
    among the top N, plus one), the leader, and what remains."""
    ranking = country_ranking(sales_df)
    top = F.col("rank") <= top_n
    agg = ranking.agg(
        F.sum(F.when(top, F.col("pct"))).alias("top_pct"),
        F.count(F.lit(1)).alias("total_countries"),
        F.sum("revenue_units").alias("total_units"),
        F.count_if(top & (F.col("cum_pct") <= threshold)).alias("below"),
        F.max(F.when(F.col("rank") == 1, F.col("Country"))).alias("leader"),
        F.max(F.when(F.col("rank") == 1, F.col("pct"))).alias("leader_pct"),
    ).filter(F.col("total_countries") > 0)
    return agg.select(
        F.round("top_pct", 2).alias("top_n_pct"),
        "total_countries",
        units_to_money("total_units").alias("total_revenue"),
        (F.col("below") + 1).alias("countries_to_threshold"),
        "leader",
        "leader_pct",
        (F.col("total_countries") - F.lit(top_n)).alias("remaining_countries"),
        F.round(100 - F.col("top_pct"), 2).alias("remaining_pct"),
    )


def pareto_table(sales_df: DataFrame, top_n: int = PARETO_TOP_N) -> DataFrame:
    """The Pareto rows as display text: ``$1,234.50``, ``12.34%``, ``$1K``."""
    p = country_pareto(sales_df, top_n)
    return p.select(
        "Country",
        money_text(F.col("revenue")).alias("revenue_text"),
        pct_text(F.col("pct")).alias("pct_text"),
        pct_text(F.col("cum_pct")).alias("cum_pct_text"),
        pct_text(F.col("cum_pct"), 1).alias("cum_pct_label"),
        thousands_text(F.col("revenue_k")).alias("revenue_k_text"),
    )
