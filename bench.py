"""Benchmark: the production path at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Setup (untimed): the retail-shaped raw view over the test tables is written
once as the ``;``-separated raw CSV the real job reads.

Timed, median of ``$BENCH_REPEAT`` runs after one warm-up (the same path as
``mercato.plans.jobs.cleaning_job`` and ``dashboard``):
* ``raw_ingest``: the raw CSV parsed once and written as Parquet;
* the raw profile reports (row count, null counts, describe, preview,
  description issues) over those columns;
* ``clean_export``: raw lines -> cleaning job -> Parquet (the S3 sink);
* ``dashboard_load``: cleaned Parquet -> typed view (text/NA normalisation,
  date parsing, incomplete lines dropped) -> Parquet, once, as the dashboard
  loads and caches its typed table;
* ``dashboard_rollups``: the rollups of the sales lines that most reports share,
  written once;
* every dashboard query over the rollups or the typed table (``clean``-level reports over the
  cleaned Parquet);
* the three round trips (raw CSV, cleaned CSV, cleaned Parquet): write and
  read back.

Each query is executed with the ``noop`` sink (the whole plan runs, nothing
is pulled to the driver). After timing, each report's rows are counted and the
file scans of its executed plan (subqueries included). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "tools"))

from plan_audit import final_plan  # noqa: E402

from mercato.plans.catalog import Retail, dashboard_queries, raw_queries  # noqa: E402
from mercato.plans.clean import clean  # noqa: E402
from mercato.plans.rollup import write_rollups  # noqa: E402
from mercato.plans.sales import load_table, sales  # noqa: E402
from mercato.session import local_session, scratch_path  # noqa: E402
from mercato.sources.files import (  # noqa: E402
    read_clean_csv,
    read_parquet,
    read_raw_csv,
    write_clean_csv,
    write_parquet,
    write_raw_csv,
)
from mercato.sources.fixture import retail_raw_view  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(fn, repeat: int) -> float:
    fn()  # warm-up
    times = []
    for _ in range(repeat):
        t0 = time.perf_counter()
        fn()
        times.append(time.perf_counter() - t0)
    return statistics.median(times)


def scans(df) -> int:
    """File scans of the plan that ran, without those of reused exchanges or subqueries."""
    lines = {line.strip(" :+-") for line in final_plan(df).splitlines() if "FileScan" in line}
    return len(lines)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = local_session(cpus)

    raw_csv = scratch_path(spark, "bench-raw-csv")
    raw_view = retail_raw_view(spark, sf_dir)
    write_raw_csv(raw_view.drop("row_key"), raw_csv)
    results: dict[str, float] = {}
    detail: dict[str, dict[str, int]] = {}

    def report(name: str, build) -> None:
        results[name] = timed(lambda: run(build()), repeat)
        df = build()
        detail[name] = {"scans": scans(df), "rows": df.count()}

    raw_path = scratch_path(spark, "bench-raw")
    results["raw_ingest"] = timed(lambda: write_parquet(read_raw_csv(spark, raw_csv), raw_path), repeat)
    raw = read_parquet(spark, raw_path)
    for name, fn in raw_queries().items():
        report(name, lambda fn=fn: fn(raw))

    clean_path = scratch_path(spark, "bench-clean")
    results["clean_export"] = timed(lambda: write_parquet(clean(raw), clean_path), repeat)

    cleaned = read_parquet(spark, clean_path)
    typed_path = scratch_path(spark, "bench-typed")
    results["dashboard_load"] = timed(lambda: write_parquet(load_table(cleaned), typed_path), repeat)

    typed_df = read_parquet(spark, typed_path)
    roll = lambda: write_rollups(spark, sales(typed_df), scratch_path(spark, "bench-rollups"))
    results["dashboard_rollups"] = timed(roll, repeat)
    retail = Retail.from_typed(spark, typed_df, cleaned, raw=raw, rollups=roll())
    for name, fn in dashboard_queries().items():
        report(name, lambda fn=fn: fn(retail))

    def round_trip(write, read, df, name: str) -> None:
        path = scratch_path(spark, f"bench-{name}")

        def go() -> None:
            write(df, path)
            run(read(spark, path))

        results[name] = timed(go, repeat)
        detail[name] = {"scans": 2, "rows": read(spark, path).count()}

    round_trip(write_raw_csv, read_raw_csv, raw, "csv_roundtrip_raw")
    round_trip(write_clean_csv, read_clean_csv, retail.clean_table, "csv_roundtrip_clean")
    round_trip(write_parquet, read_parquet, retail.clean_table, "parquet_roundtrip")

    total = sum(results.values())
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(total, 3),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in results.items()},
                "sf": sf,
                "cpus": cpus,
                "spark": spark.version,
                "repeat": repeat,
                "n_queries": len(results),
                "detail": detail,
            }
        )
    )


if __name__ == "__main__":
    main()
