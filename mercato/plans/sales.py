"""Typed view and sales view of the cleaned table.

``typed`` reproduces what the dashboard sees after the cleaned table has gone
through CSV and a pandas reader: outer spaces stripped from text, '' and the
usual NA tokens as NULL, NaN as NULL, ``InvoiceDate`` parsed to a timestamp,
and lines without ``TotalSales``, ``Quantity`` or ``InvoiceDate`` dropped (a
missing ``UnitPrice`` alone is kept). ``sales`` keeps non-returns. Both are
projections + filters only, so the ``NOT IsReturn`` filter and the column
pruning reach a Parquet scan of the cleaned table.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.parse import invoice_month_text, month_of_text, na_to_null, nan_to_null, parse_invoice_ts

_TEXT = ["Invoice", "StockCode", "Description", "DescriptionCleaned", "ProductCategory", "CustomerID", "Country"]
_FLOAT = ["UnitPrice", "TotalSales"]


def is_complete_line() -> "F.Column":
    """On the cleaned columns: the line survives ``typed``'s drop of
    incomplete lines (TotalSales, Quantity and InvoiceDate all present)."""
    return (
        nan_to_null("TotalSales").isNotNull()
        & F.col("Quantity").isNotNull()
        & parse_invoice_ts("InvoiceDate").isNotNull()
    )


def typed(clean_df: DataFrame, strict_dates: bool = False) -> DataFrame:
    cols = []
    for c in clean_df.columns:
        if c in _TEXT:
            cols.append(na_to_null(c).alias(c))
        elif c in _FLOAT:
            cols.append(nan_to_null(c).alias(c))
        elif c == "InvoiceDate":
            # through a generator of one row, past which Spark moves no filter: the text is parsed once, not also to filter
            cols.append(F.stack(F.lit(1), parse_invoice_ts(c, strict=strict_dates)).alias(c))
        else:
            cols.append(F.col(c))
    return clean_df.select(*cols).dropna(subset=["TotalSales", "Quantity", "InvoiceDate"])


def month_rows(clean_df: DataFrame) -> dict[int | None, int]:
    """Lines per month, read off the text of InvoiceDate alone (the only column scanned)."""
    texts = clean_df.groupBy(invoice_month_text("InvoiceDate").alias("t")).agg(F.count(F.lit(1)).alias("rows"))
    months = texts.groupBy(month_of_text("t").alias("m")).agg(F.sum("rows").alias("rows"))
    return {m: rows for m, rows in months.collect()}  # years have four digits, so months are bounded


def month_ranges(rows: dict[int | None, int], partitions: int) -> list[tuple[int, int, int]]:
    """(month, first partition, how many) in order of time: whole months side by side in partitions of about equal
    size, but a month of over one and a half times that size is dealt over several."""
    known = sorted(m for m in rows if m is not None)
    share, out, before = max(1.0, sum(rows[m] for m in known) / partitions), [], 0
    for m in known:
        large = rows[m] > 1.5 * share
        first = min(int((before if large else before + rows[m] / 2) / share), partitions - 1)
        out.append((m, first, min(math.ceil(rows[m] / share), partitions - first) if large else 1))
        before += rows[m]
    return out


def load_table(clean_df: DataFrame, months: dict[int | None, int] | None = None, partitions: int | None = None) -> DataFrame:
    """The typed view as it is written once for the dashboard: laid out by month and sorted by time, so every file
    covers a stretch of time and a period filter skips whole files by their statistics.

    Which months go to which partition follows from the lines per month (``months``; counted from the one text column
    if not given), so no line is parsed to find the bounds. A month with more lines than a partition should hold is
    dealt over several by a hash of the line.
    """
    n = partitions or int(clean_df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = month_ranges(month_rows(clean_df) if months is None else months, n)
    t = typed(clean_df)
    if not ranges:
        return t
    month = month_index()
    first = F.create_map(*[F.lit(x) for m, start, _ in ranges for x in (m, start)])
    spread = {m: k for m, _, k in ranges if k > 1}
    target = F.try_element_at(first, month)
    if spread:
        deal = F.create_map(*[F.lit(x) for m, k in spread.items() for x in (m, k)])
        target = target + F.coalesce(F.pmod(F.xxhash64(*[F.col(c) for c in t.columns if c != "InvoiceDate"]), F.try_element_at(deal, month)), F.lit(0))
    return t.repartitionById(n, F.coalesce(target, F.lit(0)).cast("int")).sortWithinPartitions("InvoiceDate")


def sales(typed_df: DataFrame) -> DataFrame:
    return typed_df.filter(~F.col("IsReturn"))


def month_index(ts: str = "InvoiceDate"):
    """Months since year 0: the integer key that lines are grouped by."""
    return F.year(ts) * 12 + F.month(ts) - 1


def month_text(index: str):
    """'2010-12' of a month index (made after aggregation)."""
    i = F.col(index)
    return F.format_string("%04d-%02d", F.floor(i / 12).cast("int"), F.pmod(i, F.lit(12)) + 1)


def year_month(ts: str = "InvoiceDate"):
    return F.date_format(F.col(ts), "yyyy-MM")


def with_time_attributes(df: DataFrame, ts: str = "InvoiceDate") -> DataFrame:
    """YearMonth ('2010-12'), Year, Month, MonthName ('Dec'), Fecha (date), Hora."""
    t = F.col(ts)
    return df.select(
        "*",
        year_month(ts).alias("YearMonth"),
        F.year(t).alias("Year"),
        F.month(t).alias("Month"),
        F.date_format(t, "MMM").alias("MonthName"),
        F.to_date(t).alias("Fecha"),
        F.hour(t).alias("Hora"),
    )
