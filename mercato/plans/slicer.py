"""Country / period slicer: ticket of a country against the global ticket.

Parameters (country, period range, products only) are function arguments.
When ``country`` is None the default is taken from the data (``Australia``
if it sells, else the first country in order) through a scalar subquery.

Ticket = mean over invoices of the invoice total. Both the country and the
global ticket come from **one** aggregate per invoice (one shuffle on
Invoice, none over the ``tickets`` rollup, which is bucketed by it; per-task
partial sums first, so an invoice with many lines sends one row per task),
carrying the invoice total and the part of it in the selected
country. An empty country selection gives an empty result.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.classify import pct_difference, verdict
from ..functions.money import LIMBS, mean_money, share, sum_limbs, units_to_money
from ..functions.text import money_text, signed_pct_text
from ..operators.ranking import over_all, top_k
from ..schema import DEFAULT_COUNTRY
from .rollup import lines_of, priced, revenue, revenue_limbs
from .sales import month_index, month_text, year_month


def slicer_countries(sales_df: DataFrame) -> DataFrame:
    return sales_df.filter(F.col("Country").isNotNull()).select("Country").distinct().orderBy("Country")


def slicer_periods(sales_df: DataFrame) -> DataFrame:
    months = sales_df.select(month_index().alias("_m")).distinct()
    return months.select(month_text("_m").alias("YearMonth")).orderBy("YearMonth")


def _defaults_agg(sales_df: DataFrame, preferred: str = DEFAULT_COUNTRY) -> DataFrame:
    c = F.col("Country")
    agg = sales_df.agg(
        F.coalesce(F.max(F.when(c == preferred, c)), F.min(c)).alias("default_country"),
        F.min("InvoiceDate").alias("first"),
        F.max("InvoiceDate").alias("last"),
    )
    return agg.select("default_country", year_month("first").alias("period_from"), year_month("last").alias("period_to"))


def slicer_defaults(sales_df: DataFrame, preferred: str = DEFAULT_COUNTRY) -> DataFrame:
    return _defaults_agg(sales_df, preferred).filter(F.col("period_from").isNotNull())


def default_country(sales_df: DataFrame, preferred: str = DEFAULT_COUNTRY) -> Column:
    return _defaults_agg(sales_df, preferred).select("default_country").scalar()


def _month_start(period: str, months_ahead: int = 0) -> Column:
    """First instant of 'YYYY-MM' (+ months_ahead) as a TIMESTAMP_NTZ literal."""
    m = re.fullmatch(r"(\d{4})-(\d{2})", period)
    if not m or not 1 <= int(m.group(2)) <= 12:
        raise ValueError(f"a period is written YYYY-MM, not {period!r}")
    y, mo = divmod(int(m.group(1)) * 12 + int(m.group(2)) - 1 + months_ahead, 12)
    return F.lit(f"{y:04d}-{mo + 1:02d}-01 00:00:00").cast("timestamp_ntz")


def period_filter(df: DataFrame, period_from: str | None, period_to: str | None) -> DataFrame:
    """Lines of the months from ``period_from`` to ``period_to`` ('YYYY-MM',
    inclusive), as a range on the timestamp itself, which Spark pushes into the
    Parquet scan so row groups outside the period are skipped."""
    ts = F.col("InvoiceDate")
    if period_from is not None:
        df = df.filter(ts >= _month_start(period_from))
    if period_to is not None:
        df = df.filter(ts < _month_start(period_to, 1))
    return df


def selection(
    sales_df: DataFrame,
    country: str | None = None,
    period_from: str | None = None,
    period_to: str | None = None,
    products_only: bool = True,
    default_from: DataFrame | None = None,
) -> tuple[DataFrame, Column]:
    """The base rows (months inclusive; ``UnitPrice > 0`` when
    ``products_only``) with their month index ``_m``, and the country predicate. The default
    country comes from ``default_from`` (a smaller rollup of the same lines) if given."""
    base = period_filter(sales_df, period_from, period_to).select("*", month_index().alias("_m"))
    if products_only:
        base = base.filter(priced(sales_df))
    target = F.lit(country) if country is not None else default_country(sales_df if default_from is None else default_from)
    return base, F.coalesce(F.col("Country") == target, F.lit(False))


def _per_invoice(base: DataFrame, in_country: Column, *keys: str) -> DataFrame:
    """Per invoice: the limbs of its total and of its part in the country, and the country's units and lines."""
    own = revenue_limbs(base)
    return base.groupBy(*keys, "Invoice").agg(
        *[F.sum(own[i]).alias(f"total_{i}") for i in range(LIMBS)],
        *[F.sum(F.when(in_country, own[i])).alias(f"country_{i}") for i in range(LIMBS)],
        F.sum(F.when(in_country, F.col("Quantity"))).alias("units_country"),
        F.sum(F.when(in_country, lines_of(base)).otherwise(0)).alias("lines_country"),
    )


def slicer_metrics(sales_df: DataFrame, country: str | None = None, period_from: str | None = None,
                   period_to: str | None = None, products_only: bool = True, default_from: DataFrame | None = None) -> DataFrame:
    base, in_country = selection(sales_df, country, period_from, period_to, products_only, default_from)
    inv = _per_invoice(base, in_country)
    has_inv = F.col("Invoice").isNotNull()
    in_c = has_inv & (F.col("lines_country") > 0)
    agg = inv.agg(
        sum_limbs("country").alias("rev"),
        sum_limbs("country", in_c).alias("tc_units"),
        F.count_if(in_c).alias("invoices"),
        sum_limbs("total", has_inv).alias("tg_units"),
        F.count_if(has_inv).alias("all_invoices"),
        F.sum("units_country").alias("units"),
        F.sum("lines_country").alias("lines"),
    ).filter(F.col("lines") > 0)
    # exact means as doubles for the comparison, displayed rounded half-even
    tc = F.coalesce(share("tc_units", "invoices"), F.lit(0.0))
    tg = F.coalesce(share("tg_units", "all_invoices"), F.lit(0.0))
    diff = pct_difference(tc, tg)
    return agg.select(
        units_to_money("rev").alias("revenue"),
        F.coalesce(mean_money("tc_units", "invoices"), F.lit(0.0)).alias("ticket_country"),
        F.coalesce(mean_money("tg_units", "all_invoices"), F.lit(0.0)).alias("ticket_global"),
        F.round(diff, 4).alias("diff_pct"),
        F.round(F.abs(diff), 4).alias("diff_abs_pct"),
        signed_pct_text(diff).alias("diff_text"),
        "invoices",
        "units",
        verdict(diff).alias("verdict"),
    )


def ticket_monthly(sales_df: DataFrame, country: str | None = None, period_from: str | None = None,
                   period_to: str | None = None, products_only: bool = True, default_from: DataFrame | None = None) -> DataFrame:
    """Per month: mean invoice total in the country and globally, sorted by
    month; the country ticket is NULL in months without country invoices.

    This is the full outer merge of the country and the global monthly
    series. Both series come from the same rows (country lines are a subset),
    so instead of two aggregations joined on the month — which would scan and
    shuffle the fact table twice — one per-(month, invoice) aggregate feeds
    one per-month aggregate carrying both series. An empty country selection
    gives no rows.
    """
    base, in_country = selection(sales_df, country, period_from, period_to, products_only, default_from)
    inv = _per_invoice(base, in_country, "_m")
    has_inv = F.col("Invoice").isNotNull()
    has_country = has_inv & (F.col("lines_country") > 0)
    monthly = inv.groupBy("_m").agg(
        sum_limbs("country", has_country).alias("c_units"),
        F.count_if(has_country).alias("c_invoices"),
        sum_limbs("total", has_inv).alias("g_units"),
        F.count_if(has_inv).alias("g_invoices"),
        F.sum("lines_country").alias("c_lines"),
    )
    # the guard runs over one row per month only, and counts lines without an invoice as well
    any_country = F.sum("c_lines").over(over_all()) > 0
    return (
        monthly.select("*", any_country.alias("_keep"))
        .filter(F.col("_keep") & (F.col("g_invoices") > 0))
        .select(
            month_text("_m").alias("YearMonth"),
            mean_money("c_units", "c_invoices").alias("ticket_country"),
            mean_money("g_units", "g_invoices").alias("ticket_global"),
        )
        .orderBy("YearMonth")
    )


def slicer_top_products(sales_df: DataFrame, country: str | None = None, period_from: str | None = None,
                        period_to: str | None = None, products_only: bool = True, n: int = 5,
                        default_from: DataFrame | None = None) -> DataFrame:
    base, in_country = selection(sales_df, country, period_from, period_to, products_only, default_from)
    agg = (
        base.filter(in_country & F.col("DescriptionCleaned").isNotNull())
        .groupBy(F.col("DescriptionCleaned").alias("product"))
        .agg(revenue(base).alias("rev"), F.sum("Quantity").alias("quantity"))
    )
    top = top_k(agg, n, [F.col("rev").desc()], ["product"])
    return top.select("product", money_text(units_to_money("rev")).alias("revenue_text"), "quantity")
