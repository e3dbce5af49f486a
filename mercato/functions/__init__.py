"""Column expressions: parsing/coercion, classifiers, money/percent text."""

from .classify import (
    before_paren,
    clean_description,
    day_part,
    extreme_label,
    pct_difference,
    price_class,
    product_category,
    verdict,
)
from .parse import decimal_comma_to_double, na_to_null, nan_to_null, parse_invoice_ts
from .text import money_text, pct_text, signed_pct_text, thousands_text

__all__ = [
    "before_paren",
    "clean_description",
    "day_part",
    "extreme_label",
    "pct_difference",
    "price_class",
    "product_category",
    "verdict",
    "decimal_comma_to_double",
    "na_to_null",
    "nan_to_null",
    "parse_invoice_ts",
    "money_text",
    "pct_text",
    "signed_pct_text",
    "thousands_text",
]

from .money import (  # noqa: E402
    MONEY_SCALE,
    half_even_div,
    mean_money,
    money_units,
    share,
    sum_units,
    units_to_money,
)

__all__ += ["MONEY_SCALE", "half_even_div", "mean_money", "money_units", "share", "sum_units", "units_to_money"]
