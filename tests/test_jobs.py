"""The cleaning job and the dashboard as single calls, on the edge rows."""

import os

import pytest

from retail_rows import EDGE_ROWS
from mercato.plans.jobs import cleaning_job, dashboard
from mercato.schema import CLEAN_COLUMNS, RAW
from mercato.session import scratch_path
from mercato.sources.files import read_parquet, write_raw_csv


def test_cleaning_job_and_dashboard(spark):
    src = scratch_path(spark, "t-job-src")
    out = scratch_path(spark, "t-job-out")
    write_raw_csv(spark.createDataFrame(EDGE_ROWS, RAW), src)
    reports = cleaning_job(spark, src, out, single_csv_file=True)
    assert reports["row_count"].first()["total"] == 13
    cats = {r["ProductCategory"]: r["count"] for r in reports["category_distribution"].collect()}
    assert cats["PRODUCT"] == 8
    assert reports["returns_impact"].first()["revenue_without_returns"] == pytest.approx(131.90)
    csv_files = [f for f in os.listdir(out + "/cleaned_csv") if f.startswith("part-")]
    assert len(csv_files) == 1
    cleaned = read_parquet(spark, out + "/cleaned.parquet")
    assert cleaned.columns == CLEAN_COLUMNS and cleaned.count() == 13

    dash = dashboard(spark, cleaned, scratch_path(spark, "t-job-load"), country="Germany")
    head = dash["kpi_headline"].first()
    assert head["revenue"] == pytest.approx(127.90) and head["lines"] == 8
    m = dash["slicer_metrics"].first()
    assert m["verdict"] == "lower" and m["ticket_global"] == pytest.approx(21.32)
    assert [r["Country"] for r in dash["country_pareto"].collect()][:2] == ["United Kingdom", "EIRE"]
    for name, df in dash.items():
        df.collect()  # every report runs
