"""Query catalogue: every registered query as ``(spark, sf_dir) -> DataFrame``.

``Retail`` wires the layers: raw view -> ``clean`` -> ``typed`` -> ``sales``;
each is a lazy DataFrame, so a query only reads the columns and rows it needs,
always from the tables as they are when it runs. Writing the cleaned and the
typed table once and querying them many times is an explicit step
(``Retail.from_typed``, ``plans.jobs``); building a query writes nothing, but
for the three round trips, whose point it is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..schema import CLEAN_COLUMNS, RAW_COLUMNS
from ..session import ensure_checkpoint_dir
from ..sources.files import (
    read_clean_csv,
    read_parquet,
    read_raw_csv,
    write_clean_csv,
    write_parquet,
    write_raw_csv,
)
from ..sources.fixture import retail_raw_view
from . import countries, geo, hours, kpis, prices, quality, slicer, trends
from .clean import clean
from .rollup import Rollups
from .sales import sales, typed

ROW_KEY = "row_key"


@dataclass
class Retail:
    spark: SparkSession
    raw: DataFrame | None
    clean: DataFrame
    typed: DataFrame
    sales: DataFrame
    typed_written: bool = False
    rollups: Rollups | None = None

    @classmethod
    def from_tables(cls, spark: SparkSession, sf_dir: str) -> "Retail":
        raw = retail_raw_view(spark, sf_dir)
        c = clean(raw, keep=[ROW_KEY])
        t = typed(c)
        return cls(spark, raw, c, t, sales(t))

    @classmethod
    def from_clean(cls, spark: SparkSession, clean_df: DataFrame, raw: DataFrame | None = None) -> "Retail":
        t = typed(clean_df)
        return cls(spark, raw, clean_df, t, sales(t))

    @classmethod
    def from_typed(
        cls, spark: SparkSession, typed_df: DataFrame, clean_df: DataFrame, raw: DataFrame | None = None,
        rollups: Rollups | None = None,
    ) -> "Retail":
        """Start from an already written typed table (the dashboard's loaded,
        typed frame), so reports skip the per-row text and date handling, and
        from rollups of its sales lines, which the reports read where they can."""
        return cls(spark, raw, clean_df, typed_df, sales(typed_df), typed_written=True, rollups=rollups)

    @property
    def activity(self) -> DataFrame:
        """What reports by country and time add up."""
        return self.sales if self.rollups is None else self.rollups.activity

    @property
    def by_product(self) -> DataFrame:
        """What reports by product add up."""
        return self.sales if self.rollups is None else self.rollups.products

    @property
    def by_invoice(self) -> DataFrame:
        """What reports per invoice add up."""
        return self.sales if self.rollups is None else self.rollups.tickets

    @property
    def clean_table(self) -> DataFrame:
        """The 14-column cleaned table (without the row key)."""
        return self.clean.select(*CLEAN_COLUMNS)


QueryFn = Callable[[SparkSession, str], DataFrame]

def raw_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw lines (with row key) derived from the tables."""
    return retail_raw_view(spark, sf_dir)


def retail_for(spark: SparkSession, sf_dir: str) -> Retail:
    return Retail.from_tables(spark, sf_dir)


def _roundtrip_path(spark: SparkSession, sf_dir: str, name: str) -> str:
    """One folder per round trip and input; the next call overwrites it."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/mercato/{name}-{hashlib.md5(sf_dir.encode()).hexdigest()[:12]}"


def _csv_roundtrip_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _roundtrip_path(spark, sf_dir, "raw_csv")
    write_raw_csv(raw_table(spark, sf_dir).drop(ROW_KEY), path)
    return read_raw_csv(spark, path)


def _csv_roundtrip_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _roundtrip_path(spark, sf_dir, "clean_csv")
    write_clean_csv(retail_for(spark, sf_dir).clean_table, path)
    return read_clean_csv(spark, path)


def _parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _roundtrip_path(spark, sf_dir, "clean_parquet")
    write_parquet(retail_for(spark, sf_dir).clean_table, path)
    return read_parquet(spark, path)


def dashboard_queries() -> dict[str, Callable[[Retail], DataFrame]]:
    """Queries that only need the layered views (usable on any Retail)."""
    return {
        "clean_retail": lambda r: r.clean_table,
        "sales_view_counts": lambda r: quality.sales_view_counts(r.clean, r.typed if r.typed_written else None),
        "kpi_headline": lambda r: kpis.kpi_headline(r.sales, r.activity, r.by_invoice),
        "kpi_secondary": lambda r: kpis.kpi_secondary(r.typed),
        "sales_time_attributes": lambda r: kpis.sales_time_attributes(r.activity),
        "daily_revenue": lambda r: kpis.daily_revenue(r.activity),
        "top_countries": lambda r: countries.top_countries(r.activity),
        "top_products": lambda r: kpis.top_products(r.by_product),
        "returns_summary": lambda r: quality.returns_summary(r.clean),
        "returns_impact": lambda r: quality.returns_impact(r.clean),
        "customer_coverage": lambda r: quality.customer_coverage(r.clean),
        "customer_sales_share": lambda r: quality.customer_sales_share(r.clean),
        "category_distribution": lambda r: quality.category_distribution(r.clean),
        "monthly_trend": lambda r: trends.monthly_trend(r.by_invoice),
        "monthly_extremes": lambda r: trends.monthly_extremes(r.activity),
        "country_pareto": lambda r: countries.country_pareto(r.activity),
        "pareto_summary": lambda r: countries.pareto_summary(r.activity),
        "pareto_table": lambda r: countries.pareto_table(r.activity),
        "price_outlier_summary": lambda r: prices.price_outlier_summary(r.sales),
        "zero_price_products": lambda r: prices.zero_price_products(r.sales),
        "high_price_products": lambda r: prices.high_price_products(r.sales),
        "price_scatter_sample": lambda r: prices.price_scatter_sample(r.sales),
        "geo_dimension_present": lambda r: geo.geo_dimension_present(r.spark, r.activity),
        "country_geo": lambda r: geo.country_geo(r.spark, r.activity),
        "geo_international": lambda r: geo.geo_international(r.spark, r.activity),
        "geo_top3": lambda r: geo.geo_top3(r.spark, r.activity),
        "geo_top3_names": lambda r: geo.geo_top3_names(r.spark, r.activity),
        "hourly_activity": lambda r: hours.hourly_activity(r.by_invoice),
        "day_part_summary": lambda r: hours.day_part_summary(r.by_invoice),
        "peak_hour": lambda r: hours.peak_hour(r.by_invoice),
        "slicer_countries": lambda r: slicer.slicer_countries(r.activity),
        "slicer_periods": lambda r: slicer.slicer_periods(r.activity),
        "slicer_defaults": lambda r: slicer.slicer_defaults(r.activity),
        "slicer_metrics": lambda r: slicer.slicer_metrics(r.by_invoice, default_from=r.activity),
        "ticket_monthly": lambda r: slicer.ticket_monthly(r.by_invoice, default_from=r.activity),
        "slicer_top_products": lambda r: slicer.slicer_top_products(r.by_product, default_from=r.activity),
        "slicer_metrics_period": lambda r: slicer.slicer_metrics(
            r.by_invoice, country="Germany", period_from="1994-03", period_to="1996-06", products_only=False),
        "ticket_monthly_period": lambda r: slicer.ticket_monthly(
            r.by_invoice, country="France", period_from="1993-07", period_to="1997-02"),
        "slicer_top_products_all": lambda r: slicer.slicer_top_products(
            r.by_product, country="United Kingdom", period_from="1995-01", products_only=False),
        "raw_rows": lambda r: kpis.raw_rows(r.sales),
    }


def raw_queries() -> dict[str, Callable[[DataFrame], DataFrame]]:
    """Profiling queries over the raw lines (need the raw view)."""
    return {
        "raw_preview": lambda raw: quality.raw_preview(raw),
        "row_count": lambda raw: quality.row_count(raw.select(*[f"`{c}`" for c in RAW_COLUMNS])),
        "null_counts": lambda raw: quality.raw_null_counts(raw),
        "describe_columns": lambda raw: quality.raw_describe(raw),
        "description_issues": lambda raw: quality.description_issues(raw),
    }


def queries() -> dict[str, QueryFn]:
    out: dict[str, QueryFn] = {
        "csv_roundtrip_raw": _csv_roundtrip_raw,
        "csv_roundtrip_clean": _csv_roundtrip_clean,
        "parquet_roundtrip": _parquet_roundtrip,
    }
    for name, fn in raw_queries().items():
        out[name] = lambda spark, sf_dir, fn=fn: fn(raw_table(spark, sf_dir))
    for name, fn in dashboard_queries().items():
        out[name] = lambda spark, sf_dir, fn=fn: fn(retail_for(spark, sf_dir))
    return out
