"""Geographic revenue with the country centroid dimension.

The fact table is first aggregated to one row per country; only that small
result meets the dimension, which is a literal of known size and therefore
broadcast (it is a literal of 38 rows). Unmapped countries drop out of
the inner join, so geo totals cover mapped countries only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.money import share, units_to_money
from ..operators.joins import present_members
from ..operators.ranking import position, top_k, total_over_all
from ..schema import COUNTRY_CENTROIDS, HOME_MARKET
from ..sources.geo import geo_dimension
from .countries import rank_order, revenue_by_country


def geo_dimension_present(spark: SparkSession, sales_df: DataFrame) -> DataFrame:
    """Dimension entries whose country occurs in the sales (left semi join)."""
    return present_members(geo_dimension(spark), sales_df, "Country").orderBy("Country")


def _mapped_revenue(spark: SparkSession, sales_df: DataFrame) -> DataFrame:
    geo = F.broadcast(geo_dimension(spark))
    return revenue_by_country(sales_df).join(geo, on="Country", how="inner")


def country_geo(spark: SparkSession, sales_df: DataFrame) -> DataFrame:
    return (
        _mapped_revenue(spark, sales_df)
        .orderBy(*rank_order())
        .select("Country", units_to_money("revenue_units").alias("revenue"), "lat", "lon")
    )


def geo_international(spark: SparkSession, sales_df: DataFrame, home: str = HOME_MARKET) -> DataFrame:
    return country_geo(spark, sales_df).filter(F.col("Country") != home)


def geo_top3(spark: SparkSession, sales_df: DataFrame, home: str = HOME_MARKET, n: int = 3) -> DataFrame:
    """Top ``n`` mapped markets outside ``home``: position, revenue, percent of
    all mapped revenue and percent of mapped revenue outside ``home``."""
    intl = F.col("Country") != home
    g = _mapped_revenue(spark, sales_df).select(
        "Country",
        "revenue_units",
        total_over_all("revenue_units").alias("total_all"),
        total_over_all(F.when(intl, F.col("revenue_units"))).alias("total_intl"),
    )
    top = top_k(g.filter(intl), n, rank_order())
    return top.select(
        position(rank_order()).alias("position"),
        "Country",
        units_to_money("revenue_units").alias("revenue"),
        F.round(share("revenue_units", "total_all") * 100, 4).alias("pct_global"),
        F.round(share("revenue_units", "total_intl") * 100, 4).alias("pct_intl"),
    )


def geo_top3_names(spark: SparkSession, sales_df: DataFrame, home: str = HOME_MARKET) -> DataFrame:
    """The top markets' names joined with ', ' in rank order (one row)."""
    top = geo_top3(spark, sales_df, home)
    names = F.transform(
        F.array_sort(F.collect_list(F.struct("position", "Country"))), lambda s: s["Country"]
    )
    return top.agg(F.array_join(names, ", ").alias("top3_names"))
