"""Headline and secondary KPIs, time attributes, daily revenue, top products.

Reports that only add up take the sales lines or a rollup of them
(``plans.rollup``). Money sums are exact (integer units, see ``functions.money``); money means are
rounded half-even to 2 dp (4 dp for the mean unit price) in integer
arithmetic; other ratios are rounded to 6 dp.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.money import mean_money, sum_units, units_to_money
from ..operators.ranking import top_k
from .rollup import line_count, revenue
from .sales import month_index, month_text


def distinct_count(df: DataFrame, col: str) -> Column:
    """Scalar subquery: distinct values of a column, NULL not counted. One two-level aggregate that reads this column
    alone; several distinct counts in one aggregate would make a row per line and count (Expand)."""
    return df.select(F.col(col).alias("_d")).filter(F.col("_d").isNotNull()).distinct().agg(F.count(F.lit(1))).scalar()


def kpi_headline(sales_df: DataFrame, activity: DataFrame | None = None, tickets: DataFrame | None = None) -> DataFrame:
    """Revenue, units, distinct invoices, average ticket (revenue / invoices,
    0 when there are none), lines and distinct products; sums of nothing are 0.
    Sums come from ``activity`` and invoices from ``tickets`` where given."""
    lines = sales_df if activity is None else activity
    agg = lines.agg(
        F.coalesce(revenue(lines), F.lit(0).cast("decimal(38,0)")).alias("rev"),
        F.coalesce(F.sum("Quantity"), F.lit(0).cast("bigint")).alias("units"),
        line_count(lines).alias("lines"),
    ).select(
        "*",
        distinct_count(sales_df if tickets is None else tickets, "Invoice").alias("invoices"),
        distinct_count(sales_df, "StockCode").alias("products"),
    )
    return agg.select(
        units_to_money("rev").alias("revenue"),
        "units",
        "invoices",
        F.coalesce(mean_money("rev", "invoices"), F.lit(0.0)).alias("avg_ticket"),
        "lines",
        "products",
    )


def kpi_secondary(typed_df: DataFrame) -> DataFrame:
    """Distinct customers, countries and mean unit price over sales, and the
    return rate over **all** typed lines. The distinct counts read their own column."""
    sale = ~F.col("IsReturn")
    sale_price = F.when(sale, F.col("UnitPrice"))
    sales_df = typed_df.filter(sale)
    agg = typed_df.agg(
        F.count_if("IsReturn").alias("returns"),
        F.count(F.lit(1)).alias("lines"),
        sum_units(sale_price).alias("price_units"),
        F.count(sale_price).alias("priced"),
    ).select(
        "*",
        distinct_count(sales_df.filter("HasCustomerID"), "CustomerID").alias("customers"),
        distinct_count(sales_df, "Country").alias("countries"),
    )
    return agg.select(
        "customers",
        F.round(F.try_divide(F.col("returns"), F.col("lines")) * 100, 6).alias("return_rate"),
        "countries",
        mean_money("price_units", "priced", 4).alias("mean_price"),
    )


def sales_time_attributes(sales_df: DataFrame) -> DataFrame:
    """Line count per (Year, Month, MonthName, YearMonth)."""
    months = sales_df.groupBy(month_index().alias("_m")).agg(line_count(sales_df).alias("lines"))
    first = F.make_date(F.floor(F.col("_m") / 12).cast("int"), F.pmod("_m", F.lit(12)) + 1, F.lit(1))
    return months.select(
        F.year(first).alias("Year"),
        F.month(first).alias("Month"),
        F.date_format(first, "MMM").alias("MonthName"),
        month_text("_m").alias("YearMonth"),
        "lines",
    ).orderBy("YearMonth")


def daily_revenue(sales_df: DataFrame) -> DataFrame:
    return (
        sales_df.groupBy(F.to_date("InvoiceDate").alias("Fecha"))
        .agg(units_to_money(revenue(sales_df)).alias("revenue"))
        .orderBy("Fecha")
    )


def monthly_revenue(sales_df: DataFrame) -> DataFrame:
    """Revenue (exact units) and distinct invoices per YearMonth."""
    months = sales_df.groupBy(month_index().alias("_m")).agg(
        revenue(sales_df).alias("revenue_units"), F.countDistinct("Invoice").alias("invoices")
    )
    return months.select(month_text("_m").alias("YearMonth"), "revenue_units", "invoices")


def top_products(sales_df: DataFrame, n: int = 15) -> DataFrame:
    """Top ``n`` products (cleaned description) by revenue, with quantity.
    Lines without a description are left out of the ranking."""
    agg = (
        sales_df.filter(F.col("DescriptionCleaned").isNotNull())
        .groupBy(F.col("DescriptionCleaned").alias("product"))
        .agg(revenue(sales_df).alias("rev"), F.sum("Quantity").alias("quantity"))
    )
    return top_k(agg, n, [F.col("rev").desc()], ["product"]).select(
        "product", units_to_money("rev").alias("revenue"), "quantity"
    )


def raw_rows(sales_df: DataFrame, n: int = 100, order_key: str = "row_key") -> DataFrame:
    """The first ``n`` sales lines in a stable order, seven columns."""
    cols = ["Invoice", "DescriptionCleaned", "Quantity", "UnitPrice", "TotalSales", "Country", "InvoiceDate"]
    order = [order_key] if order_key in sales_df.columns else cols
    return sales_df.orderBy(*order).limit(n).select(*cols)
