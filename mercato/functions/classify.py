"""Row classifiers as ``CASE WHEN`` chains (no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import (
    CATEGORY_DEFAULT,
    CATEGORY_RULES,
    DAY_PART_OTHER,
    DAY_PARTS,
    PRICE_CLASS_EXTREME_PREFIX,
    PRICE_CLASS_EXTREME_SUFFIX,
    PRICE_CLASS_NORMAL,
    PRICE_CLASS_ZERO,
    UNKNOWN_DESCRIPTION,
    VERDICT_BAND,
    VERDICT_HIGHER,
    VERDICT_LOWER,
    VERDICT_SIMILAR,
)


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def clean_description(col: str | Column) -> Column:
    """trim (spaces only) -> upper -> NULL becomes 'UNKNOWN'.

    A blank description trims to '' which is not NULL, so it stays ''.
    """
    return F.coalesce(F.upper(F.trim(_c(col))), F.lit(UNKNOWN_DESCRIPTION))


def product_category(col: str | Column) -> Column:
    """First matching rule of ``CATEGORY_RULES`` on the cleaned description."""
    c = _c(col)
    expr = None
    for kind, text, category in CATEGORY_RULES:
        cond = c.contains(text) if kind == "contains" else (c == F.lit(text))
        expr = F.when(cond, F.lit(category)) if expr is None else expr.when(cond, F.lit(category))
    return expr.otherwise(F.lit(CATEGORY_DEFAULT))


def day_part(hour: str | Column) -> Column:
    h = _c(hour)
    expr = None
    for lo, hi, label in DAY_PARTS:
        cond = (h >= lo) & (h < hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(DAY_PART_OTHER))


def before_paren(col: str | Column) -> Column:
    """Text before the first '(' with outer spaces removed."""
    return F.trim(F.substring_index(_c(col), "(", 1))


def extreme_label(threshold: Column) -> Column:
    """Label of the extreme-price class: the threshold rounded half-even to
    a whole number, as text."""
    return F.concat(
        F.lit(PRICE_CLASS_EXTREME_PREFIX),
        F.bround(threshold, 0).cast("bigint").cast("string"),
        F.lit(PRICE_CLASS_EXTREME_SUFFIX),
    )


def price_class(price: str | Column, threshold: Column) -> Column:
    """zero / extreme (strictly above ``threshold``) / normal; a missing price
    is normal because both comparisons are false."""
    p = _c(price)
    return (
        F.when(p == 0, F.lit(PRICE_CLASS_ZERO))
        .when(p > threshold, extreme_label(threshold))
        .otherwise(F.lit(PRICE_CLASS_NORMAL))
    )


def pct_difference(value: Column, reference: Column) -> Column:
    """(value - reference) / reference * 100, 0 when reference is not positive."""
    return F.when(reference > 0, (value - reference) / reference * 100).otherwise(F.lit(0.0))


def verdict(diff_pct: Column, band: float = VERDICT_BAND) -> Column:
    return (
        F.when(diff_pct > band, F.lit(VERDICT_HIGHER))
        .when(diff_pct < -band, F.lit(VERDICT_LOWER))
        .otherwise(F.lit(VERDICT_SIMILAR))
    )
