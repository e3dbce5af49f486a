"""Plan-shape checks: the physical plans we rely on at scale."""

import os
import sys

import pytest

from retail_rows import SF_SMALL
from mercato.plans import countries, geo, hours, kpis, prices, rollup, slicer, trends
from mercato.plans.catalog import Retail, dashboard_queries
from mercato.plans.clean import clean
from mercato.session import scratch_path
from mercato.sources.files import read_parquet, write_parquet

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))


@pytest.fixture(scope="module")
def retail(spark):
    # the production path: the cleaned table written once, queried many times
    r = Retail.from_tables(spark, SF_SMALL)
    path = scratch_path(spark, "test-plans-clean")
    write_parquet(r.clean, path)
    return Retail.from_clean(spark, read_parquet(spark, path))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sales_filter_and_pruning_reach_the_scan(retail):
    p = plan(countries.top_countries(retail.sales))
    assert "PushedFilters: [IsNotNull(IsReturn), Not(EqualTo(IsReturn,true))]" in p
    scan = [line for line in p.splitlines() if "FileScan parquet" in line][0]
    assert "Description," not in scan and "StockCode" not in scan  # pruned


def test_top_k_is_take_ordered(retail):
    for df in (countries.top_countries(retail.sales), kpis.top_products(retail.sales),
               prices.price_scatter_sample(retail.sales)):
        assert "TakeOrderedAndProject" in plan(df)


def test_geo_dimension_is_broadcast(spark, retail):
    df = geo.country_geo(spark, retail.sales)
    df.collect()
    p = plan(df)
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_no_python_udf_anywhere(spark, retail):
    for name, fn in dashboard_queries().items():
        p = plan(fn(retail))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def _children(node):
    kids = node.children()
    return [kids.apply(i) for i in range(kids.size())]


def _has(node, name):
    return node.nodeName().startswith(name) or any(_has(c, name) for c in _children(node))


def _windows(node):
    found = [node] if node.nodeName() == "Window" else []
    return found + [w for c in _children(node) for w in _windows(c)]


def test_windows_only_over_aggregates(spark, retail):
    """Every Window operator must sit above an aggregate, never directly on the
    scanned fact rows (an un-partitioned window would pull them to one task)."""
    for df in (trends.monthly_trend(retail.sales), countries.country_pareto(retail.sales),
               hours.hourly_activity(retail.sales), slicer.ticket_monthly(retail.sales)):
        windows = _windows(df._jdf.queryExecution().sparkPlan())
        assert windows and all(_has(w, "HashAggregate") for w in windows)


def test_price_filter_is_below_the_aggregate(retail):
    """Only lines above the threshold are aggregated to products."""
    p = prices.high_price_products(retail.sales)._jdf.queryExecution().optimizedPlan().toString()
    at_filter = [i for i, line in enumerate(p.splitlines()) if "Filter" in line and "scalar-subquery" in line]
    at_aggregate = [i for i, line in enumerate(p.splitlines()) if "Aggregate [DescriptionCleaned" in line and "UnitPrice" in line]
    assert at_filter and at_aggregate and min(at_filter) > min(at_aggregate)


def test_months_are_grouped_as_numbers(retail):
    """Month text is made after the aggregation, never per line."""
    for df in (kpis.sales_time_attributes(retail.sales), trends.monthly_trend(retail.sales), slicer.slicer_periods(retail.sales),
               slicer.slicer_defaults(retail.sales), slicer.ticket_monthly(retail.sales, country="Germany")):
        p = df._jdf.queryExecution().optimizedPlan().toString()
        lowest = [i for i, line in enumerate(p.splitlines()) if "Aggregate" in line][-1]
        below = "\n".join(p.splitlines()[lowest + 1:])
        assert "date_format" not in below and "format_string" not in below


def test_sample_orders_few_rows(spark):
    """The rows that are ordered for the sample do not grow with the number of tasks."""
    from pyspark.sql import functions as F

    sales_df = spark.range(0, 200_000, 1, 64).select(
        F.col("id").cast("string").alias("row_key"), F.lit(1.0).alias("UnitPrice"), F.lit(1).alias("Quantity"),
        F.lit("x").alias("DescriptionCleaned"), F.lit("y").alias("Country"), F.col("id").cast("string").alias("Invoice"))
    got = {r["Invoice"] for r in prices.price_scatter_sample(sales_df, n=700).collect()}
    want = {r["id"] for r in sales_df.select(F.col("row_key").alias("id"), prices.sample_key(sales_df).alias("k")).orderBy("k").limit(700).collect()}
    assert got == want
    keyed = sales_df.select(prices.sample_key(sales_df).alias("_k"))
    assert 700 <= keyed.filter(F.col("_k") < prices.key_bound(700, 200_000)).count() < 2 * 700
    assert prices.key_bound(700, 800) is None and prices.key_bound(5, 0) is None


def test_sample_widens_its_bound_when_equal_lines_share_a_key(spark):
    """Nine tenths of the lines are one line, so a bound from the number of lines finds too few."""
    from pyspark.sql import functions as F

    sales_df = spark.range(40_000).select(
        F.when(F.col("id") < 4_000, F.col("id")).otherwise(-1).cast("string").alias("row_key"), F.lit(1.0).alias("UnitPrice"),
        F.lit(1).alias("Quantity"), F.lit("x").alias("DescriptionCleaned"), F.lit("y").alias("Country"),
        F.when(F.col("id") < 4_000, F.col("id")).otherwise(-1).cast("string").alias("Invoice"))
    got = sorted(r["Invoice"] for r in prices.price_scatter_sample(sales_df, n=300).collect())
    want = sorted(r["id"] for r in sales_df.select(F.col("row_key").alias("id"), prices.sample_key(sales_df).alias("k")).orderBy("k").limit(300).collect())
    assert got == want


def test_distinct_counts_need_no_expand(retail):
    for df in (kpis.kpi_headline(retail.sales), kpis.kpi_secondary(retail.typed)):
        assert "Expand" not in plan(df)


def test_invoice_sums_over_the_bucketed_rollup_need_no_shuffle(spark, retail):
    """Below the first aggregate there is the scan alone."""
    rolled = rollup.write_rollups(spark, retail.sales, scratch_path(spark, "test-rollups"), buckets=4)
    for df in (slicer.slicer_metrics(rolled.tickets, country="Germany"), slicer.ticket_monthly(rolled.tickets, country="Germany"),
               kpis.monthly_revenue(rolled.tickets), hours.hourly(rolled.tickets)):
        lines = plan(df).splitlines()
        scan = next(i for i, line in enumerate(lines) if "FileScan parquet" in line)
        aggregates = [i for i, line in enumerate(lines[:scan]) if "Aggregate" in line]
        assert "Bucketed: true" in lines[scan] and "SelectedBucketsCount" in lines[scan]
        assert not any("Exchange" in line for line in lines[aggregates[-2]:scan]), plan(df)


def test_load_samples_no_bounds(spark, retail):
    """The layout follows from the lines per month: no range partitioning, whose bounds take a pass that parses every line."""
    from mercato.plans.sales import load_table

    p = plan(load_table(retail.clean))
    assert "rangepartitioning" not in p and p.count("FileScan parquet") == 1
    assert p.count("regexp_replace") == 1  # parsed once, not also in the filter


def test_ticket_monthly_scans_sales_once(spark, retail):
    """Both monthly series come from one aggregate: besides the default-country
    subquery there is exactly one scan of the fact table."""
    p = plan(slicer.ticket_monthly(retail.sales, country="Germany"))
    assert p.count("FileScan parquet") == 1


def test_clean_is_one_projection(spark):
    from mercato.sources.fixture import retail_raw_view

    p = plan(clean(retail_raw_view(spark, SF_SMALL)))
    assert "HashAggregate" not in p  # no aggregation in the cleaning projection


@pytest.fixture(scope="module")
def loaded(spark, retail):
    """The typed table written once, as jobs and bench do it."""
    from mercato.plans.sales import load_table

    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")  # untruncated PushedFilters
    path = scratch_path(spark, "test-plans-typed")
    write_parquet(load_table(retail.clean), path)
    return Retail.from_typed(spark, read_parquet(spark, path), retail.clean)


def test_period_range_reaches_the_scan(loaded):
    df = slicer.slicer_metrics(loaded.sales, country="Germany", period_from="1995-01", period_to="1995-12")
    df.collect()
    p = plan(df)
    assert "GreaterThanOrEqual(InvoiceDate,1995-01-01T00:00)" in p
    assert "LessThan(InvoiceDate,1996-01-01T00:00)" in p


def test_period_filter_equals_text_comparison(retail):
    from mercato.plans.sales import year_month

    periods = [r["YearMonth"] for r in slicer.slicer_periods(retail.sales).collect()]
    mid = len(periods) // 2
    for lo, hi in [(periods[0], periods[-1]), (periods[mid - 1], periods[mid]), (periods[mid], periods[mid])]:
        fast = slicer.period_filter(retail.sales, lo, hi).count()
        ym = year_month()
        slow = retail.sales.filter((ym >= lo) & (ym <= hi)).count()
        assert fast == slow and fast > 0
    with pytest.raises(ValueError, match="YYYY-MM"):
        slicer.period_filter(retail.sales, periods[mid][:4], None)


def test_loaded_table_is_laid_out_by_time(spark, loaded):
    """Every file of the loaded table covers a stretch of time of its own."""
    from pyspark.sql import functions as F

    stretches = loaded.typed.groupBy(F.input_file_name().alias("f")).agg(
        F.min("InvoiceDate").alias("lo"), F.max("InvoiceDate").alias("hi")).orderBy("lo").collect()
    assert all(a["hi"] <= b["lo"] for a, b in zip(stretches, stretches[1:]))


def test_sales_view_counts_same_with_written_typed_table(retail, loaded):
    from mercato.plans import quality

    inline = quality.sales_view_counts(retail.clean).first()
    from_table = quality.sales_view_counts(loaded.clean, loaded.typed).first()
    assert tuple(inline) == tuple(from_table)
    assert "try_make_timestamp_ntz" not in plan(quality.sales_view_counts(loaded.clean, loaded.typed))


def test_price_summary_scans_once(loaded):
    """The quantile and the summary share one price histogram."""
    from plan_audit import final_plan

    assert final_plan(prices.price_outlier_summary(loaded.sales)).count("FileScan parquet") == 1
