"""Exact money arithmetic on primitive sums.

Line totals are doubles (price x quantity). Summing doubles gives results
that change in the last bits with partitioning and task order, so at scale
the same query would return slightly different revenue from run to run. All
money aggregates therefore sum whole **units of 1e-10**, associatively.

A line's units are split into three BIGINT limbs (``limbs``): multiples of
2**40 currency units (nearly always 0), the nearest multiple of 1/128 of the
rest, and what is left in units. The splits are exact, each limb is summed as
a plain BIGINT, and the limbs are carried into one DECIMAL(38, 0) once per group
(``sum_units``, ``sum_limbs``). The last limb of a line is between -39,062,500
and 39,062,500, so its sum holds for 2e11 lines of a group whatever they are;
the others hold for 1e13 lines of 1,000 currency units each.

A line contributes its double, rounded to ten decimals: below 2**19 a value
written with ten decimals or fewer counts as written, below 5e-11 it counts as
0. NaN and infinite values are no numbers and count as missing. No finite value
is left out silently: in Spark's ANSI mode (its default) a value from about 1e31
on, and a sum over 1e28, raise an error. A sum is turned back into a double
once, at the end.

``half_even_div`` rounds an exact quotient of two whole numbers half-to-even,
so displayed means and thousands never depend on how a binary double happens
to sit next to a .5 tie.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_SCALE = 10_000_000_000
LIMBS = 3
_HIGH, _FINE = 1 << 40, 128
#: What one of each limb is worth, in units.
WORTH = (MONEY_SCALE * _HIGH, MONEY_SCALE // _FINE, 1)


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _decimal(c: Column | int) -> Column:
    return (F.lit(str(c)) if isinstance(c, int) else c).cast("decimal(38,0)")


def limbs(col: str | Column) -> list[Column]:
    """The BIGINT limbs of a money value; NULL for a missing one.

    Without branches, so that Spark computes what the limbs share once a row:
    x * 0 is 0 for a finite x and NaN otherwise. All factors but the last are
    powers of two, so only the last product is rounded.
    """
    x = _c(col).cast("double")
    x = x + F.nanvl(x * 0.0, F.lit(None).cast("double"))
    high = (x * (1.0 / _HIGH)).cast("bigint")
    rest = x - high.cast("double") * float(_HIGH)
    fine = F.rint(rest * float(_FINE))
    return [high, fine.cast("bigint"), F.rint((rest - fine * (1.0 / _FINE)) * float(MONEY_SCALE)).cast("bigint")]


def _carry(parts: list[Column]) -> Column:
    total = _decimal(parts[0]) * _decimal(WORTH[0])
    for part, worth in zip(parts[1:], WORTH[1:], strict=True):
        total = (total + _decimal(part) * _decimal(worth)).cast("decimal(38,0)")
    return total


def money_units(col: str | Column) -> Column:
    """Money value -> DECIMAL(38, 0) units of 1/MONEY_SCALE (one value; sums go by ``sum_units``)."""
    return _carry(limbs(col))


def sum_units(col: str | Column, weight: str | Column | None = None) -> Column:
    """Exact sum of a money column (times a BIGINT ``weight``), in units (NULL when there is nothing)."""
    own = limbs(col)
    return _carry([F.sum(x if weight is None else x * _c(weight)) for x in own])


def limb_sums(col: str | Column, name: str) -> list[Column]:
    """The sums of the limbs as columns ``name_0``, ``name_1``, ..., to be summed further."""
    return [F.sum(x).alias(f"{name}_{i}") for i, x in enumerate(limbs(col))]


def limb_names(name: str) -> list[str]:
    return [f"{name}_{i}" for i in range(LIMBS)]


def sum_limbs(name: str, where: Column | None = None) -> Column:
    """Units of the sum of limb columns ``name_0`` ... (only of rows ``where``)."""
    return _carry([F.sum(F.col(c) if where is None else F.when(where, F.col(c))) for c in limb_names(name)])


def carried(name: str) -> Column:
    """Units of one row's limb columns."""
    return _carry([F.col(c) for c in limb_names(name)])


def units_to_money(units: str | Column) -> Column:
    return _c(units).cast("double") / float(MONEY_SCALE)


def share(part: str | Column, whole: str | Column) -> Column:
    """Quotient of two unit sums as a double; NULL when the whole is 0."""
    return F.try_divide(_c(part).cast("double"), _c(whole).cast("double"))


def _rounded(n: Column, d: Column, kind: str) -> Column:
    """Half-even quotient of n by d > 0 with whole numbers of one type."""
    a = F.abs(n)
    q = F.call_function("div", a, d)
    r = a - q.cast(kind) * d
    up = (r > d - r) | ((r == d - r) & (F.pmod(q, F.lit(2)) == 1))
    rounded = q + up.cast("bigint")
    return F.when(n < 0, -rounded).otherwise(rounded)


def half_even_div(num: str | Column, den: str | Column) -> Column:
    """round_half_even(num / den) for whole num (BIGINT or DECIMAL(38, 0)) and
    den > 0, exactly, with integral division (``div``) and a remainder test;
    symmetric for num < 0. A non-positive den is treated as 1 (callers guard
    that case). Numbers of up to 18 digits are divided as BIGINT."""
    n = _decimal(_c(num))
    d = F.greatest(_decimal(_c(den)), _decimal(1))
    fits = (F.abs(n) < _decimal(10**18)) & (d < _decimal(10**18))
    small = _rounded(n.cast("decimal(18,0)").cast("bigint"), d.cast("decimal(18,0)").cast("bigint"), "bigint")
    return F.when(fits, small).otherwise(_rounded(n, d, "decimal(20,0)"))


def mean_money(units_sum: str | Column, count: str | Column, decimals: int = 2) -> Column:
    """Mean of a money column from its unit sum and count, rounded half-even
    to ``decimals`` exactly; NULL when count is 0."""
    step = MONEY_SCALE // (10**decimals)
    c = _c(count)
    rounded = half_even_div(units_sum, c.cast("decimal(20,0)") * F.lit(step).cast("decimal(11,0)"))
    return F.when(c > 0, rounded / float(10**decimals))
