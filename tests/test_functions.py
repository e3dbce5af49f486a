"""Column functions against plain-Python expectations."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mercato.functions.classify import before_paren, day_part, price_class, product_category, verdict
from mercato.functions.parse import decimal_comma_to_double, na_to_null, nan_to_null, parse_invoice_ts
from mercato.schema import DAY_PART_OTHER, DAY_PARTS, NA_TOKENS


def one_col(spark, expr, values, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_parse_invoice_ts_edges(spark):
    got = one_col(spark, parse_invoice_ts, [
        "1/12/2009 7:45", "01/12/2009 07:45", "31/12/2010 23:59", "31/2/2010 10:00",
        "n/a", None, "1/12/2009", "01/12/2009 07:45:00", "1/12/2009  7:45", "x/12/2009 7:45",
        "1/12/09 7:45", "1/12/20090 7:45", "1/12/-209 7:45", "+1/12/2009 7:45", "1/12/2009 7:45\n", "1/12/2009 7:+5", "001/12/2009 7:45",
    ])
    assert got[:3] == [dt.datetime(2009, 12, 1, 7, 45), dt.datetime(2009, 12, 1, 7, 45), dt.datetime(2010, 12, 31, 23, 59)]
    assert got[3:] == [None] * 14


def test_parse_invoice_ts_strict_raises(spark):
    for text in ("n/a", "1/12/09 7:45"):
        df = spark.createDataFrame([(text,)], "x string")
        with pytest.raises(Exception, match="bad InvoiceDate"):
            df.select(parse_invoice_ts("x", strict=True)).collect()
    ok = spark.createDataFrame([("1/1/2010 0:00",), (None,)], "x string")
    assert ok.select(parse_invoice_ts("x", strict=True)).count() == 2


@settings(max_examples=60, deadline=None)
@given(st.datetimes(min_value=dt.datetime(1900, 1, 1), max_value=dt.datetime(2100, 12, 31)), st.booleans())
def test_parse_invoice_ts_matches_strptime(spark, ts, padded):
    text = ts.strftime("%d/%m/%Y %H:%M") if padded else f"{ts.day}/{ts.month}/{ts.year} {ts.hour}:{ts.minute:02d}"
    expect = dt.datetime.strptime(text, "%d/%m/%Y %H:%M")
    assert one_col(spark, parse_invoice_ts, [text]) == [expect]


def test_decimal_comma(spark):
    got = one_col(spark, decimal_comma_to_double, ["6,95", "18", "0", "n/a", None, "10,5", ""])
    assert got == [6.95, 18.0, 0.0, None, None, 10.5, None]


def test_na_tokens_and_nan(spark):
    got = one_col(spark, na_to_null, NA_TOKENS + ["  NA ", "NAN", "box", " box "])
    assert got == [None] * (len(NA_TOKENS) + 1) + ["NAN", "box", "box"]
    assert one_col(spark, nan_to_null, [float("nan"), 1.5, None], "double") == [None, 1.5, None]


def test_product_category_order(spark):
    got = one_col(spark, product_category, [
        "POSTAGE", "BANK CHARGES", "DISCOUNT ON POSTAGE", "CARRIAGE", "UNKNOWN", "UNKNOWN ITEM", "", "BOX",
    ])
    assert got == ["SERVICE_SHIPPING", "SERVICE_FEES", "SERVICE_SHIPPING", "SERVICE_SHIPPING", "UNKNOWN",
                   "PRODUCT", "PRODUCT", "PRODUCT"]


def test_day_part_boundaries(spark):
    hours = list(range(24))
    got = one_col(spark, day_part, hours, "int")
    for h, label in zip(hours, got):
        want = next((lab for lo, hi, lab in DAY_PARTS if lo <= h < hi), DAY_PART_OTHER)
        assert label == want
    assert one_col(spark, before_paren, ["🌅 Madrugada (6-9h)", "no paren"]) == ["🌅 Madrugada", "no paren"]


def test_price_class_and_verdict(spark):
    got = one_col(spark, lambda c: price_class(c, F.lit(13.2)), [0.0, 13.2, 13.3, None, 2.5], "double")
    assert got == ["🚫 Precio = $0", "✅ Normal", "📈 Precio extremo (>$13)", "✅ Normal", "✅ Normal"]
    assert one_col(spark, verdict, [10.0, 10.01, -10.0, -10.01, 0.0], "double") == [
        "similar", "higher", "similar", "lower", "similar"]
