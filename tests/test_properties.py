"""Invariants on the sf0.001 retail view, money helpers and text formats."""

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from retail_rows import SF_SMALL
from mercato.functions.money import half_even_div
from mercato.functions.text import pct_text, signed_pct_text
from mercato.plans import countries, hours, kpis, prices, quality
from mercato.plans.catalog import Retail


@pytest.fixture(scope="module")
def retail(spark):
    return Retail.from_tables(spark, SF_SMALL)


def test_revenue_with_equals_without_plus_returns(retail):
    c = retail.clean
    imp = quality.returns_impact(c).first()
    neg = c.filter("Quantity <= 0").agg(F.sum("TotalSales")).first()[0]
    assert imp["revenue_with_returns"] == pytest.approx(imp["revenue_without_returns"] + neg)


def test_categories_add_up(retail):
    total = sum(r["count"] for r in quality.category_distribution(retail.clean).collect())
    assert total == retail.clean.count()


def test_day_parts_add_up_to_revenue(retail):
    parts = sum(r["revenue"] for r in hours.day_part_summary(retail.sales).collect())
    head = kpis.kpi_headline(retail.sales).first()
    assert parts == pytest.approx(head["revenue"])


def test_cumulative_percent_never_decreases(retail):
    cum = [r["cum_pct"] for r in countries.country_pareto(retail.sales).collect()]
    assert cum == sorted(cum)


def test_sample_is_a_subset_of_min_n(retail):
    n_sales = retail.sales.count()
    sample = prices.price_scatter_sample(retail.sales, n=500)
    assert sample.count() == min(500, n_sales)
    cols = ["Invoice", "UnitPrice", "Quantity"]
    assert sample.select(*cols).exceptAll(retail.sales.select(*cols)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.integers(min_value=-(10**15), max_value=10**15), st.integers(min_value=1, max_value=10**9))
def test_half_even_div_matches_python(spark, n, d):
    got = spark.range(1).select(half_even_div(F.lit(n).cast("bigint"), F.lit(d).cast("bigint"))).first()[0]
    # Python's round() on a Fraction-like exact value: use integer arithmetic
    q, r = divmod(abs(n), d)
    if 2 * r > d or (2 * r == d and q % 2 == 1):
        q += 1
    assert got == (q if n >= 0 else -q)


@pytest.mark.parametrize("x", [0.125, 0.375, 69.505, -71.85, 1234.5, -0.04, 99.995, 12.0])
def test_percent_text_matches_python(spark, x):
    row = spark.range(1).select(pct_text(F.lit(x)).alias("a"), signed_pct_text(F.lit(x)).alias("b")).first()
    assert row["a"] == f"{x:.2f}%"
    assert row["b"] == f"{x:+.1f}%"
    assert not math.isnan(x)


@settings(max_examples=25, deadline=None)
@given(
    st.lists(st.sampled_from([0.0, 1.25, 2.5, 7.0, 13.2, 18.0, 99.99]) | st.floats(0, 1000).map(lambda x: round(x, 2)),
             min_size=1, max_size=60),
    st.sampled_from([0.0, 0.25, 0.5, 0.8, 1.0]),
)
def test_exact_quantile_matches_percentile(spark, values, q):
    from mercato.operators.quantile import exact_quantile

    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = exact_quantile(df, "x", q).first()[0]
    want = df.agg(F.percentile("x", q)).first()[0]
    assert got == pytest.approx(want, abs=1e-9)


@pytest.mark.parametrize("reuse", ["true", "false"])
@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_exact_quantile_needs_no_optimizer_rule(spark, reuse, adaptive):
    """The same value as percentile, with exchange reuse and adaptive execution on and off."""
    from mercato.operators.quantile import exact_quantile

    df = spark.range(200_000).select(((F.pmod(F.xxhash64("id"), F.lit(2_000_000_000)) - 300_000_000) / 97.0).alias("x"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.exchange.reuse", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.exchange.reuse", reuse)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        for q in (0.0, 0.1, 0.8, 1.0):
            assert exact_quantile(df, "x", q).first()[0] == pytest.approx(df.agg(F.percentile("x", q)).first()[0], rel=1e-12)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.floats(allow_nan=False) | st.sampled_from([0.0, -0.0, 0.5, 1.0, 2.0, 3.9999999999999996, 4.0, 5e-324]), min_size=2, max_size=30))
def test_value_bucket_is_monotone(spark, values):
    from mercato.operators.quantile import value_bucket

    df = spark.createDataFrame([(v,) for v in values], "x double").select("x", value_bucket(F.col("x")).alias("b"))
    rows = sorted((r["x"], r["b"]) for r in df.collect())
    assert [b for _, b in rows] == sorted(b for _, b in rows)


def test_money_sums_lose_nothing_and_have_no_low_ceiling(spark):
    from mercato.functions.money import mean_money, sum_units, units_to_money

    def total(values):
        df = spark.createDataFrame([(float(v),) for v in values], "x double")
        return df.agg(sum_units("x").alias("u"), F.count("x").alias("n")).select(units_to_money("u").alias("m"), mean_money("u", "n").alias("mean")).first()

    assert total([0.00004] * 1000)["m"] == 0.04
    assert total([5e14, 5e14])["m"] == pytest.approx(1e15, rel=3e-16) and total([5e14, 5e14])["mean"] == 5e14
    assert total([4e17] * 50)["m"] == pytest.approx(2e19, rel=3e-16) and total([2e20] * 10)["m"] == pytest.approx(2e21, rel=3e-16)
    assert total([float("inf"), 2.5, float("nan")])["m"] == 2.5
    assert total([0.005, 0.015, 0.025])["mean"] == 0.02 and total([0.125])["mean"] == 0.12


def test_money_at_its_limits(spark):
    """Below 5e-11 a line counts as 0; from about 1e31 on it is an error, as is a sum over 1e28; nothing leaves a sum silently."""
    from mercato.functions.money import money_units, sum_units, units_to_money

    def total(values):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        return df.agg(sum_units("x").alias("u")).select(units_to_money("u").alias("m")).first()["m"]

    assert total([4e-11] * 1000) == 0.0 and total([6e-11] * 10) == 1e-9 and total([1e-10] * 1000) == 1e-7
    assert total([]) is None and total([None, float("nan")]) is None and total([-0.0]) == 0.0
    assert total([1e27, 5.0, -1e27]) == 5.0 and total([2.0**90, 0.25, -(2.0**90)]) == 0.25
    assert total([1e15, 0.1, -1e15, 0.2]) == 0.3
    for values in ([2e28, 5.0], [1e32], [-1e300], [6e27, 6e27]):
        with pytest.raises(Exception, match="OVERFLOW|NUMERIC_VALUE_OUT_OF_RANGE|ARITHMETIC"):
            total(values)
    units = spark.createDataFrame([(6.95,), (-0.1,), (524287.1234567891,)], "x double").select(money_units("x").alias("u")).collect()
    assert [int(r["u"]) for r in units] == [69500000000, -1000000000, 5242871234567891]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.floats(min_value=-1e17, max_value=1e17), min_size=1, max_size=20))
def test_money_sums_are_those_of_exact_fractions(spark, values):
    """Each double rounded to ten decimals, summed as whole numbers."""
    from fractions import Fraction

    from mercato.functions.money import sum_units

    got = spark.createDataFrame([(v,) for v in values], "x double").agg(sum_units("x").alias("u")).first()["u"]
    want = sum(Fraction(v) * 10**10 for v in values)
    assert abs(int(got) - want) <= Fraction(len(values), 2) + Fraction(len(values), 10**6)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(0, 40), st.integers(1, 10_000), min_size=1, max_size=12), st.integers(1, 12))
def test_months_are_laid_out_in_order_and_evenly(rows, partitions):
    from mercato.plans.sales import month_ranges

    out = month_ranges(rows | {None: 5}, partitions)
    assert [m for m, _, _ in out] == sorted(rows)
    assert all(0 <= first and first + k <= partitions and k >= 1 for _, first, k in out)
    assert all(a[1] + a[2] - 1 <= b[1] for a, b in zip(out, out[1:]))
    load = [0.0] * partitions
    for m, first, k in out:
        for i in range(first, first + k):
            load[i] += rows[m] / k
    share = max(1.0, sum(rows.values()) / partitions)
    assert max(load) <= 4 * share


def test_replaced_input_changes_the_answer(spark, tmp_path):
    import os
    import shutil

    import pyarrow.parquet as pq

    from mercato.plans import catalog

    for t in ("lineitem", "orders", "customer", "part"):
        shutil.copy(f"{SF_SMALL}/{t}.parquet", tmp_path / f"{t}.parquet")
    before = catalog.queries()["row_count"](spark, str(tmp_path)).first()[0]
    pq.write_table(pq.read_table(f"{SF_SMALL}/lineitem.parquet").slice(0, 1000), tmp_path / "new.parquet")
    os.replace(tmp_path / "new.parquet", tmp_path / "lineitem.parquet")
    spark.catalog.refreshByPath(str(tmp_path))
    assert catalog.queries()["row_count"](spark, str(tmp_path)).first()[0] == 1000 < before
