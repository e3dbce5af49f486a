"""Money and percent text.

``format_number`` rounds the exact binary value half-even, as Python's
``format`` does; ``format_string('%.1f')`` would round half-up instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _format(col: Column, pattern: str) -> Column:
    """SQL ``format_number(x, 'pattern')`` (a DecimalFormat pattern)."""
    return F.call_function("format_number", col, F.lit(pattern))


def money_text(col: Column, decimals: int = 2) -> Column:
    """``$1,234.50``"""
    return F.concat(F.lit("$"), F.format_number(col, decimals))


def thousands_text(col: Column) -> Column:
    """``$123K`` from a value already in thousands (no decimals)."""
    return F.concat(F.lit("$"), _format(col, "0"), F.lit("K"))


def pct_text(col: Column, decimals: int = 2) -> Column:
    """``12.34%``"""
    pattern = "0." + "0" * decimals if decimals else "0"
    return F.concat(_format(col, pattern), F.lit("%"))


def signed_pct_text(col: Column, decimals: int = 1) -> Column:
    """``+5.2%`` / ``-71.8%``"""
    pattern = "0." + "0" * decimals if decimals else "0"
    body = _format(col, pattern)
    return F.concat(F.when(body.startswith("-"), F.lit("")).otherwise(F.lit("+")), body, F.lit("%"))
