"""Additive rollups of the sales lines, written once and shared by the reports.

Most reports are sums over a few keys. ``write_rollups`` aggregates the lines
once per grain and writes the results; a report then reads a rollup in place of
the lines and gives the same numbers:

* ``activity``: country, day and hour: everything by country, day, month or
  hour that counts no distinct invoices;
* ``products``: product, country, month, and whether the line has a price;
* ``tickets``: invoice, country, day, hour, and whether the line has a price;
  bucketed by invoice, so that sums and distinct counts per invoice need no
  shuffle of their own.

A rollup has the columns of the lines that it keeps, under their names
(``InvoiceDate`` is the start of the hour or month), ``Quantity`` summed,
``Lines`` (how many), and the limbs of ``TotalSales`` summed (see
``functions.money``). ``revenue`` and ``line_count`` read either kind of table.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.money import limb_names, limb_sums, limbs, sum_limbs, sum_units
from ..operators.materialize import write_and_reread


@dataclass
class Rollups:
    activity: DataFrame
    products: DataFrame
    tickets: DataFrame


def is_rollup(df: DataFrame) -> bool:
    return "Lines" in df.columns


def revenue(df: DataFrame) -> Column:
    """Exact sum of TotalSales, in units."""
    return sum_limbs("TotalSales") if is_rollup(df) else sum_units("TotalSales")


def revenue_limbs(df: DataFrame) -> list[Column]:
    """The limbs of each row's TotalSales."""
    return [F.col(c) for c in limb_names("TotalSales")] if is_rollup(df) else limbs("TotalSales")


def line_count(df: DataFrame) -> Column:
    """How many lines (0 for none)."""
    return F.coalesce(F.sum("Lines"), F.lit(0).cast("bigint")) if is_rollup(df) else F.count(F.lit(1))


def lines_of(df: DataFrame) -> Column:
    """How many lines a row stands for."""
    return F.col("Lines") if is_rollup(df) else F.lit(1).cast("bigint")


def priced(df: DataFrame) -> Column:
    """Whether the line has a price above 0."""
    return F.col("Priced") if is_rollup(df) else F.coalesce(F.col("UnitPrice") > 0, F.lit(False))


def _rolled(sales_df: DataFrame, keys: dict[str, Column]) -> DataFrame:
    return sales_df.groupBy(*[c.alias(n) for n, c in keys.items()]).agg(
        F.count(F.lit(1)).alias("Lines"), F.sum("Quantity").alias("Quantity"), *limb_sums("TotalSales", "TotalSales")
    )


_HOURLY = {"_day": F.to_date, "_hour": F.hour}


def _hour_start(df: DataFrame) -> DataFrame:
    """InvoiceDate from the day and hour that were grouped by."""
    start = F.col("_day").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.col("_hour"))
    return df.withColumn("InvoiceDate", start).drop("_day", "_hour")


def activity(sales_df: DataFrame) -> DataFrame:
    keys = {n: f("InvoiceDate") for n, f in _HOURLY.items()}
    return _hour_start(_rolled(sales_df, {"Country": F.col("Country")} | keys))


def products(sales_df: DataFrame) -> DataFrame:
    keys = {"DescriptionCleaned": F.col("DescriptionCleaned"), "Country": F.col("Country"),
            "_month": F.trunc("InvoiceDate", "month"), "Priced": priced(sales_df)}
    return _rolled(sales_df, keys).withColumn("InvoiceDate", F.col("_month").cast("timestamp_ntz")).drop("_month")


def tickets(sales_df: DataFrame) -> DataFrame:
    keys = {n: f("InvoiceDate") for n, f in _HOURLY.items()}
    return _hour_start(_rolled(sales_df, {"Invoice": F.col("Invoice"), "Country": F.col("Country")} | keys | {"Priced": priced(sales_df)}))


def write_by_invoice(spark: SparkSession, df: DataFrame, path: str, buckets: int | None = None) -> DataFrame:
    """Write ``df`` to ``path`` in buckets by Invoice (one file each) and read it as a table of that layout.

    Spark keeps the layout in its catalog, so the table has a name of its own there; its files stay at ``path``.
    """
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"mercato_tickets_{uuid.uuid4().hex}"
    df.repartition(n, "Invoice").write.bucketBy(n, "Invoice").sortBy("Invoice").option("path", path).format("parquet").saveAsTable(name)
    return spark.table(name)


def write_rollups(spark: SparkSession, sales_df: DataFrame, path: str, buckets: int | None = None) -> Rollups:
    """Write the three rollups under ``path`` (which must be new)."""
    root = path.rstrip("/")
    return Rollups(
        activity=write_and_reread(spark, activity(sales_df), "activity", f"{root}/activity"),
        products=write_and_reread(spark, products(sales_df), "products", f"{root}/products"),
        tickets=write_by_invoice(spark, tickets(sales_df), f"{root}/tickets", buckets),
    )
