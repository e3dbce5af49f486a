"""Data-quality reports of the cleaning job.

Each report is one scan with conditional aggregates (``count_if``,
``sum(when)``), instead of one job per number. Ratios use ``try_divide`` so
an empty input gives NULL instead of an ANSI divide-by-zero error. Sums of
nothing stay NULL here, as Spark returns them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.money import sum_units, units_to_money
from ..operators.profile import describe_columns, null_counts
from ..operators.ranking import top_k
from ..schema import ISSUE_MARKERS, RAW_COLUMNS
from .sales import is_complete_line


def _pct(part, whole):
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")) * 100, 6)


def raw_preview(raw: DataFrame, n: int = 5, order_key: str = "row_key") -> DataFrame:
    """First ``n`` raw lines in a stable order (a row key, or all columns)."""
    order = [order_key] if order_key in raw.columns else RAW_COLUMNS
    return top_k(raw, n, [F.col(f"`{c}`") for c in order]).select(*[F.col(f"`{c}`") for c in RAW_COLUMNS])


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total"))


def raw_null_counts(raw: DataFrame) -> DataFrame:
    return null_counts(raw, RAW_COLUMNS)


def raw_describe(raw: DataFrame) -> DataFrame:
    return describe_columns(raw, RAW_COLUMNS)


def returns_summary(clean_df: DataFrame) -> DataFrame:
    return clean_df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("IsReturn").alias("returns"),
        F.count_if("IsCancellation").alias("cancellations"),
    ).select(
        "*",
        _pct(F.col("returns"), F.col("total")).alias("returns_pct"),
        _pct(F.col("cancellations"), F.col("total")).alias("cancellations_pct"),
    )


def returns_impact(clean_df: DataFrame) -> DataFrame:
    """Revenue with returns (all lines), without (``Quantity > 0``), and the
    difference. Exact unit sums; NULL when there is nothing to sum."""
    agg = clean_df.agg(
        sum_units("TotalSales").alias("w"),
        sum_units(F.when(F.col("Quantity") > 0, F.col("TotalSales"))).alias("wo"),
    )
    return agg.select(
        units_to_money("w").alias("revenue_with_returns"),
        units_to_money("wo").alias("revenue_without_returns"),
        units_to_money(F.col("w") - F.col("wo")).alias("returns_impact"),
    )


def customer_coverage(clean_df: DataFrame) -> DataFrame:
    agg = clean_df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("HasCustomerID").alias("with_customer"),
        F.count_if(~F.col("HasCustomerID")).alias("without_customer"),
    )
    return agg.select(
        "with_customer",
        "without_customer",
        _pct(F.col("with_customer"), F.col("total")).alias("with_customer_pct"),
        _pct(F.col("without_customer"), F.col("total")).alias("without_customer_pct"),
    )


def customer_sales_share(clean_df: DataFrame) -> DataFrame:
    positive = F.col("Quantity") > 0
    agg = clean_df.agg(
        sum_units(F.when(F.col("HasCustomerID") & positive, F.col("TotalSales"))).alias("w"),
        sum_units(F.when(~F.col("HasCustomerID") & positive, F.col("TotalSales"))).alias("wo"),
    )
    both = F.col("w") + F.col("wo")
    return agg.select(
        units_to_money("w").alias("sales_with_customer"),
        units_to_money("wo").alias("sales_without_customer"),
        _pct(F.col("w"), both).alias("with_customer_pct"),
        _pct(F.col("wo"), both).alias("without_customer_pct"),
    )


def description_issues(raw: DataFrame, n: int = 20) -> DataFrame:
    """Distinct raw descriptions that are NULL, empty, or contain a service
    marker (case-sensitive, on the raw text); first ``n`` in order."""
    d = F.col("Description")
    cond = d.isNull() | (d == "")
    for marker in ISSUE_MARKERS:
        cond = cond | d.contains(marker)
    return top_k(raw.select("Description").filter(cond).distinct(), n, [F.col("Description").asc_nulls_first()])


def category_distribution(clean_df: DataFrame) -> DataFrame:
    return clean_df.groupBy("ProductCategory").agg(F.count(F.lit(1)).alias("count")).orderBy(
        F.col("count").desc(), "ProductCategory"
    )


def sales_view_counts(clean_df: DataFrame, typed_table: DataFrame | None = None) -> DataFrame:
    """Rows loaded, rows left after dropping incomplete lines (``typed``), and
    sales rows.

    Without a written typed table this is one scan of the cleaned table that
    re-evaluates the drop condition inline. With one (``typed_table``), the
    typed and sales counts come from that table instead (one struct-valued
    scalar subquery reading only ``IsReturn``), so no date is parsed again.
    """
    if typed_table is None:
        complete = is_complete_line()
        return clean_df.agg(
            F.count(F.lit(1)).alias("rows_loaded"),
            F.count_if(complete).alias("rows_typed"),
            F.count_if(complete & ~F.col("IsReturn")).alias("rows_sales"),
        )
    typed_counts = typed_table.agg(
        F.struct(F.count(F.lit(1)).alias("t"), F.count_if(~F.col("IsReturn")).alias("s")).alias("c")
    ).scalar()
    return clean_df.agg(F.count(F.lit(1)).alias("rows_loaded")).select(
        "rows_loaded",
        typed_counts.getField("t").alias("rows_typed"),
        typed_counts.getField("s").alias("rows_sales"),
    )
