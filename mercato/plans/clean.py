"""The cleaning job: raw invoice lines -> the 14-column cleaned table.

One projection over the scan (Catalyst collapses it into a single
whole-stage-codegen span): flags, price parsing, line totals, description
normalisation and product category. No shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.classify import clean_description, product_category
from ..functions.parse import decimal_comma_to_double
from ..schema import CLEAN_COLUMNS


def clean(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Cleaned table in ``CLEAN`` column order, plus any ``keep`` columns
    present in ``raw`` (e.g. a stable row key) appended at the end."""
    qty = F.col("Quantity")
    price = decimal_comma_to_double("Price")
    desc_clean = clean_description("Description")
    extra = [c for c in keep if c in raw.columns]
    out = raw.select(
        F.col("Invoice"),
        F.col("StockCode"),
        F.col("Description"),
        desc_clean.alias("DescriptionCleaned"),
        product_category(desc_clean).alias("ProductCategory"),
        qty,
        F.col("InvoiceDate"),
        price.alias("UnitPrice"),
        F.col("`Customer ID`").alias("CustomerID"),
        F.col("Country"),
        (qty * price).alias("TotalSales"),
        F.coalesce(qty < 0, F.lit(False)).alias("IsReturn"),
        F.coalesce(F.col("Invoice").startswith("C"), F.lit(False)).alias("IsCancellation"),
        F.col("`Customer ID`").isNotNull().alias("HasCustomerID"),
        *[F.col(c) for c in extra],
    )
    assert out.columns[: len(CLEAN_COLUMNS)] == CLEAN_COLUMNS
    return out
