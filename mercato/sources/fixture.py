"""Retail-shaped raw view over the TPC-H-like test tables.

The raw file of the real workload is an invoice-line CSV. For tests and the
benchmark the same shape (with all its dirt: cancellations, returns, blank and
padded descriptions, decimal-comma prices, missing customers) is derived
deterministically from ``lineitem``/``orders``/``customer``/``part`` so that
the work grows with the given tables.

Plan shape: ``orders`` is first joined to ``customer`` (on custkey) and to the
25-row country list (broadcast; its size is fixed), which turns each order into
(key, customer, date, country). ``lineitem`` then joins that on orderkey with a
sort-merge join (both sides are fact-sized), and ``part`` on partkey (Spark/AQE
pick broadcast or sort-merge from run-time sizes; hot keys are split by AQE's
skew-join handling). Only the needed columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import RAW_COLUMNS
from ..session import table_path

# Country name for each nation key 0..24, in key order.
NATION_COUNTRIES = [
    "United Kingdom",
    "EIRE",
    "Germany",
    "France",
    "Netherlands",
    "Spain",
    "Belgium",
    "Switzerland",
    "Portugal",
    "Australia",
    "Norway",
    "Sweden",
    "Denmark",
    "Finland",
    "Austria",
    "Italy",
    "Japan",
    "Singapore",
    "United States",
    "Canada",
    "Brazil",
    "Cyprus",
    "RSA",
    "Channel Islands",
    "Unspecified",
]


def _text(c: Column) -> Column:
    return c.cast("string")


def nation_countries(spark: SparkSession) -> DataFrame:
    rows = list(enumerate(NATION_COUNTRIES))
    return spark.createDataFrame(rows, "nation_key int, nation_country string")


def retail_raw_view(spark: SparkSession, sf_dir: str, with_row_key: bool = True) -> DataFrame:
    """The raw invoice-line table (RAW schema) plus a stable ``row_key``."""
    read = lambda t: spark.read.parquet(table_path(sf_dir, t))
    lineitem = read("lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )
    orders = read("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customer = read("customer").select("c_custkey", "c_nationkey")
    part = read("part").select("p_partkey", "p_name")
    names = F.broadcast(nation_countries(spark))  # 25 rows, fixed

    order_facts = (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(names, F.col("c_nationkey") == names.nation_key)
        .select(
            "o_orderkey",
            "o_custkey",
            "o_orderdate",
            F.when(F.col("c_custkey") % 10 < 7, F.lit("United Kingdom"))
            .otherwise(F.col("nation_country"))
            .alias("Country"),
        )
    )
    # lineitem and orders are both fact-sized: always a shuffle sort-merge
    # join on the order key (spills, splits skew under AQE), never a broadcast
    # of either side; the dimension joins are left to Spark/AQE statistics.
    lines = lineitem.join(
        order_facts.hint("merge"), lineitem.l_orderkey == order_facts.o_orderkey
    ).join(part, F.col("l_partkey") == part.p_partkey)

    ok, pk, ln = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")
    qty = F.col("l_quantity").cast("int")
    # every 31st order has lines of two hours
    hour = F.lit(5) + ok % 9 + ok % 8 + F.when(ok % 31 == 0, ln % 2).otherwise(F.lit(0))
    year = F.year("o_orderdate")
    day_month = F.concat(_text(F.dayofmonth("o_orderdate")), F.lit("/"), _text(F.month("o_orderdate")), F.lit("/"))
    clock = F.concat(F.lit(" "), _text(hour), F.lit(":"), F.lpad(_text(ok % 60), 2, "0"))
    cols = [
        F.when(ok % 83 == 0, F.lit(None).cast("string"))
        .when(ok % 25 == 0, F.concat(F.lit("C"), _text(ok)))
        .otherwise(_text(ok))
        .alias("Invoice"),
        _text(pk).alias("StockCode"),
        F.when(pk % 41 == 0, F.lit(None).cast("string"))
        .when(pk % 43 == 0, F.lit("   "))
        .when(pk % 47 == 0, F.lit("postage"))
        .when(pk % 53 == 0, F.lit("BANK CHARGES"))
        .when(pk % 59 == 0, F.lit(" Discount "))
        .when(pk % 61 == 0, F.lit("carriage"))
        .otherwise(F.concat(F.lit("  "), F.col("p_name"), F.lit(" ")))
        .alias("Description"),
        F.when((ln == 7) & (ok % 71 == 0), F.lit(None).cast("int"))
        .when((ln == 6) & (ok % 67 == 0), F.lit(0))
        .when((ok % 25 == 0) | ((ln == 1) & (ok % 40 == 1)), -qty)
        .otherwise(qty)
        .alias("Quantity"),
        F.when((ln == 5) & (ok % 73 == 0), F.lit(None).cast("string"))
        .when((ln == 4) & (ok % 79 == 0), F.concat(day_month, _text(year % 100), clock))
        .when((ln == 3) & (ok % 89 == 0), F.concat(day_month, _text(year), F.lit("0"), clock))
        .when((ln == 2) & (ok % 97 == 0), F.concat(F.lit("+"), day_month, _text(year), clock))
        .otherwise(F.concat(day_month, _text(year), clock))
        .alias("InvoiceDate"),
        F.when(pk % 101 == 0, F.lit("n/a"))
        .when(pk % 97 == 0, F.lit("0"))
        .when(pk % 89 == 0, F.concat(F.lit("0,0000"), _text(pk % 9 + 1)))
        .when(pk % 83 == 0, F.concat(_text(pk % 50), F.lit(",123456")))
        .otherwise(F.concat(_text(F.lit(900) + pk % 113), F.lit(","), F.lpad(_text(pk % 100), 2, "0")))
        .alias("Price"),
        F.when(F.col("o_custkey") % 4 == 0, F.lit(None).cast("string"))
        .otherwise(_text(F.col("o_custkey")))
        .alias("Customer ID"),
        F.col("Country"),
    ]
    if with_row_key:
        cols.append(
            F.md5(
                F.concat_ws(
                    "|",
                    _text(ok),
                    _text(pk),
                    _text(F.col("l_suppkey")),
                    _text(ln),
                    _text(F.col("l_quantity").cast("bigint")),
                    _text(F.round(F.col("l_extendedprice") * 100).cast("bigint")),
                )
            ).alias("row_key")
        )
    out = lines.select(*cols)
    assert out.columns[: len(RAW_COLUMNS)] == RAW_COLUMNS
    return out
