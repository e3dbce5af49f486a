"""Reports read from rollups equal those read from the lines."""

import pytest
from retail_rows import SF_SMALL
from mercato.operators.materialize import write_and_reread
from mercato.plans import rollup
from mercato.plans.catalog import Retail, dashboard_queries
from mercato.session import scratch_path


def with_rollups(spark, r, buckets):
    rolled = rollup.write_rollups(spark, r.sales, scratch_path(spark, "t-rollups"), buckets)
    return Retail(spark, r.raw, r.clean, r.typed, r.sales, rollups=rolled)


@pytest.fixture(scope="module")
def small(spark):
    r = Retail.from_tables(spark, SF_SMALL)
    return Retail.from_clean(spark, write_and_reread(spark, r.clean, "t-rollup-clean"))


@pytest.mark.parametrize("kind", ["small", "edge"])
def test_reports_from_rollups_are_those_from_lines(spark, kind, request):
    lines = request.getfixturevalue(kind)
    rolled = with_rollups(spark, lines, 3)
    one_row_key = {"raw_rows", "price_scatter_sample", "clean_retail"}
    for name, fn in dashboard_queries().items():
        if name not in one_row_key:
            a, b = fn(lines), fn(rolled)
            assert a.schema == b.schema, name
            assert a.collect() == b.collect(), name


def test_rollups_of_no_lines(spark, edge):
    none = edge.sales.filter("false")
    rolled = rollup.write_rollups(spark, none, scratch_path(spark, "t-rollups"), 2)
    assert [df.count() for df in (rolled.activity, rolled.products, rolled.tickets)] == [0, 0, 0]
    lines = Retail(spark, None, edge.clean, edge.typed, none)
    empty = Retail(spark, None, edge.clean, edge.typed, none, rollups=rolled)
    for name in ("kpi_headline", "daily_revenue", "pareto_summary", "monthly_extremes", "peak_hour", "slicer_metrics", "slicer_defaults"):
        fn = dashboard_queries()[name]
        assert fn(lines).collect() == fn(empty).collect(), name


def test_rollups_are_smaller_than_the_lines(spark, small):
    rolled = with_rollups(spark, small, 3).rollups
    lines = small.sales.count()
    for df in (rolled.activity, rolled.products, rolled.tickets):
        assert df.agg({"Lines": "sum"}).first()[0] == lines and df.count() <= lines
