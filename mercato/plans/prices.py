"""Price outliers: zero prices and prices above a quantile of the same table.

The quantile is exact (linear interpolation, as ``percentile``), computed by
``operators.quantile.exact_quantile`` from the price histogram (lines per
price), so no task holds more than one bucket of distinct prices. The threshold
is used through a scalar subquery (``DataFrame.scalar()``): computed once,
shipped to every task as a value; no cross join. ``approx=True`` uses
``percentile_approx`` instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.classify import price_class
from ..functions.money import mean_money, sum_units
from ..operators.materialize import write_and_reread
from ..operators.quantile import exact_quantile
from ..operators.ranking import top_k
from ..schema import PRICE_QUANTILE, SAMPLE_SEED, SAMPLE_SIZE

PRODUCT = "DescriptionCleaned"


def price_histogram(sales_df: DataFrame, *keys: str) -> DataFrame:
    """Lines per (keys..., UnitPrice) and per-group partial measures."""
    return sales_df.groupBy(*keys, "UnitPrice").agg(
        F.count(F.lit(1)).alias("lines"),
        F.count("Invoice").alias("invoice_lines"),
    )


def price_lines(sales_df: DataFrame) -> DataFrame:
    """Lines per UnitPrice."""
    return sales_df.groupBy("UnitPrice").agg(F.count(F.lit(1)).alias("lines"))


def price_threshold(sales_df: DataFrame, q: float = PRICE_QUANTILE, approx: bool = False,
                    accuracy: int = 10_000) -> Column:
    """Scalar subquery for the ``q`` quantile of UnitPrice: exact by default
    (bounded per-task state), or ``percentile_approx`` (a fixed-size sketch,
    relative rank error 1/accuracy, no interpolation) with ``approx=True``."""
    if approx:
        return sales_df.agg(F.percentile_approx("UnitPrice", q, accuracy)).scalar()
    return exact_quantile(price_lines(sales_df), "UnitPrice", q, weight="lines").scalar()


def price_outlier_summary(sales_df: DataFrame, q: float = PRICE_QUANTILE, approx: bool = False) -> DataFrame:
    """Zero-price lines, the quantile, lines strictly above it, max price."""
    thr = price_threshold(sales_df, q, approx=approx)
    p = F.col("UnitPrice")
    agg = price_lines(sales_df).agg(  # the same histogram as the quantile's: scanned once, its exchange is reused
        F.coalesce(F.sum(F.when(p == 0, F.col("lines"))), F.lit(0).cast("bigint")).alias("zero_price_rows"),
        F.coalesce(F.sum(F.when(p > thr, F.col("lines"))), F.lit(0).cast("bigint")).alias("rows_above_p80"),
        F.max(p).alias("max_price"),
    )
    return agg.select("zero_price_rows", F.round(thr, 6).alias("p80"), "rows_above_p80", "max_price")


def zero_price_products(sales_df: DataFrame, n: int = 15) -> DataFrame:
    zero = sales_df.filter((F.col("UnitPrice") == 0) & F.col(PRODUCT).isNotNull())
    agg = zero.groupBy(F.col(PRODUCT).alias("product")).agg(
        F.count("Invoice").alias("lines"),
        F.sum("Quantity").alias("quantity"),
        F.countDistinct("Country").alias("countries"),
    )
    return top_k(agg, n, [F.col("lines").desc()], ["product"])


def high_price_products(sales_df: DataFrame, n: int = 15, q: float = PRICE_QUANTILE,
                        approx: bool = False) -> DataFrame:
    """Products with lines priced strictly above the quantile: max price, mean
    price (both 2 dp, half-even) and line count; top ``n`` by max price.

    The threshold is a scalar subquery and filters the lines before they are
    aggregated to the (product, price) histogram.
    """
    thr = price_threshold(sales_df, q, approx=approx)
    above = sales_df.filter((F.col("UnitPrice") > thr) & F.col(PRODUCT).isNotNull())
    agg = price_histogram(above, PRODUCT).groupBy(F.col(PRODUCT).alias("product")).agg(
        F.max("UnitPrice").alias("mx"),
        sum_units("UnitPrice", weight="lines").alias("price_units"),
        F.sum("lines").alias("priced"),
        F.sum("invoice_lines").alias("lines"),
    )
    top = top_k(agg, n, [F.col("mx").desc()], ["product"])
    return top.select(
        "product",
        F.bround("mx", 2).alias("max_price"),
        mean_money("price_units", "priced", 2).alias("mean_price"),
        "lines",
    )


#: What identifies a line where there is no row key.
LINE_KEY = ["Invoice", "StockCode", "InvoiceDate", "Quantity", "UnitPrice"]


def sample_key(df: DataFrame, seed: int = SAMPLE_SEED, order_key: str = "row_key") -> Column:
    """A seeded pseudo-random order: md5 of the seed and a stable row key (or
    of ``LINE_KEY`` when there is none)."""
    parts = [order_key] if order_key in df.columns else LINE_KEY
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in parts]))


def key_bound(wanted: int, rows: int) -> str | None:
    """A hex bound under which about ``wanted`` of ``rows`` md5 keys lie, with slack for chance; None for no bound."""
    share = (wanted + 8 * wanted**0.5 + 32) / max(rows, 1)
    return None if share >= 1 else f"{int(share * 2**52):013x}"


def price_scatter_sample(
    sales_df: DataFrame, n: int = SAMPLE_SIZE, seed: int = SAMPLE_SEED, q: float = PRICE_QUANTILE,
    approx: bool = False,
) -> DataFrame:
    """Up to ``n`` sales lines in seeded hash order, with their price class.

    Of the N lines (counted on the column of the price histogram, which the
    quantile needs too) about ``n`` have a key in the first n/N of the key
    space. One scan makes the keys and keeps the lines below that bound, a
    little widened; they are written, and counted there. Only if they are too
    few (equal lines share a key) is the bound moved up eightfold and the scan
    repeated. Whatever the number of tasks, about ``n`` lines are then ordered
    and cut to ``n``. The scans run when the report is built.
    """
    spark = sales_df.sparkSession
    thr, total = _threshold_and_rows(sales_df, q, approx)
    keyed = sales_df.select("UnitPrice", "Quantity", "DescriptionCleaned", "Country", "Invoice", sample_key(sales_df, seed).alias("_k"))
    wanted = n
    while True:
        bound = key_bound(wanted, total)
        found = write_and_reread(spark, keyed if bound is None else keyed.filter(F.col("_k") < bound), "price_sample")
        if bound is None or found.count() >= min(n, total):
            break
        wanted *= 8
    return top_k(found, n, ["_k"]).select(
        "UnitPrice",
        "Quantity",
        price_class("UnitPrice", F.lit(thr).cast("double")).alias("price_class"),
        "DescriptionCleaned",
        "Country",
        "Invoice",
    )


def _threshold_and_rows(sales_df: DataFrame, q: float, approx: bool) -> tuple[float | None, int]:
    """The price threshold and the number of lines, from one scan of the price column."""
    rows = price_lines(sales_df).agg(F.sum("lines").alias("rows"))
    row = rows.select("rows", price_threshold(sales_df, q, approx=approx).alias("thr")).first()
    return row["thr"], row["rows"] or 0
