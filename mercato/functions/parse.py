"""Parsing and coercion expressions (all built-in, JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import NA_TOKENS


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def decimal_comma_to_double(col: str | Column) -> Column:
    """``'6,95'`` -> 6.95; text that is not a number becomes NULL (try_cast,
    so ANSI mode does not abort the job on one bad value)."""
    return F.replace(_c(col), F.lit(","), F.lit(".")).try_cast("double")


#: Day, month, hour and minute of one or two digits, a year of four, nothing else.
INVOICE_DATE = r"\A([0-9]{1,2})/([0-9]{1,2})/([0-9]{4}) ([0-9]{1,2}:[0-9]{1,2})\z"


def parse_invoice_ts(col: str | Column, strict: bool = False) -> Column:
    """``'1/12/2009 7:45'`` -> TIMESTAMP_NTZ 2009-12-01 07:45 (``d/M/yyyy H:mm``).

    The text must have the shape ``INVOICE_DATE``; anything else (signs, other
    year lengths, text before or after) is NULL. One pass puts its parts in ISO
    order, and Spark's own reader of such text makes the timestamp, so the
    result never depends on the session time zone (no DST gaps) and an
    impossible date such as 31/2 becomes NULL. With ``strict=True`` a
    non-missing value that does not parse raises instead.
    """
    c = _c(col)
    iso = F.regexp_replace(c, INVOICE_DATE, "$3-$2-$1 $4:00")
    # a text of another shape stays as it is; no ISO text has its first slash so early
    parsed = F.when(F.instr(c, "/").between(2, 3), iso.try_cast("timestamp_ntz"))
    if strict:
        return F.when(c.isNotNull() & parsed.isNull(), F.raise_error(F.concat(F.lit("bad InvoiceDate: "), c))).otherwise(
            parsed
        )
    return parsed


def invoice_month_text(col: str | Column) -> Column:
    """The part of an ``InvoiceDate`` text that names the month ('12/2009'), not checked."""
    return F.substring_index(F.substring_index(_c(col), " ", 1), "/", -2)


def month_of_text(month_text: str | Column) -> Column:
    """Months since year 0 of such a part; NULL if it names no month."""
    c = _c(month_text)
    month, year = F.substring_index(c, "/", 1).try_cast("int"), F.substring_index(c, "/", -1).try_cast("int")
    return F.when(c.rlike(r"\A[0-9]{1,2}/[0-9]{4}\z") & month.between(1, 12), year * 12 + month - 1)


def na_to_null(col: str | Column) -> Column:
    """Text as a CSV writer + pandas reader would return it: outer spaces
    stripped, and pandas' default missing-value tokens (incl. '') as NULL."""
    t = F.trim(_c(col))
    return F.when(t.isin(NA_TOKENS), F.lit(None).cast("string")).otherwise(t)


def nan_to_null(col: str | Column) -> Column:
    return F.nanvl(_c(col), F.lit(None).cast("double"))
