"""The two programs of the original workload as single calls.

* ``cleaning_job``: raw CSV -> profile and data-quality reports -> cleaned
  table exported as Parquet and CSV. The CSV is parsed **once** (written as
  Parquet), so every report afterwards reads columns instead of re-parsing
  text; the original ran 17 separate actions over the CSV.
* ``dashboard``: cleaned table -> typed table written once (the dashboard's
  load) -> rollups written once (``plans.rollup``) -> every report as a lazy DataFrame, with the slicer parameters.

Run the cleaning job from a shell with
``python -m mercato.plans.jobs <raw.csv> <output_dir>``.
"""

from __future__ import annotations

import sys
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..operators.materialize import write_and_reread
from ..sources.files import read_parquet, read_raw_csv, write_clean_csv, write_parquet
from . import countries, quality, slicer
from .catalog import Retail, dashboard_queries
from .clean import clean
from .rollup import write_rollups
from .sales import load_table, sales


def cleaning_job(
    spark: SparkSession, raw_csv: str, output_dir: str, single_csv_file: bool = False
) -> dict[str, DataFrame]:
    """Clean ``raw_csv`` into ``output_dir`` and return the reports.

    Writes ``<output_dir>/raw.parquet`` (the parsed input),
    ``<output_dir>/cleaned.parquet`` and
    ``<output_dir>/cleaned_csv`` (one file when
    ``single_csv_file``; only for small exports). Reports are lazy DataFrames.
    """
    out = output_dir.rstrip("/")
    raw = write_and_reread(spark, read_raw_csv(spark, raw_csv), "raw", f"{out}/raw.parquet")
    cleaned = clean(raw)
    write_parquet(cleaned, f"{out}/cleaned.parquet")
    cleaned = read_parquet(spark, f"{out}/cleaned.parquet")
    write_clean_csv(cleaned, f"{out}/cleaned_csv", single_file=single_csv_file)
    return {
        "row_count": quality.row_count(raw),
        "raw_preview": quality.raw_preview(raw),
        "null_counts": quality.raw_null_counts(raw),
        "describe_columns": quality.raw_describe(raw),
        "returns_summary": quality.returns_summary(cleaned),
        "returns_impact": quality.returns_impact(cleaned),
        "customer_coverage": quality.customer_coverage(cleaned),
        "customer_sales_share": quality.customer_sales_share(cleaned),
        "description_issues": quality.description_issues(raw),
        "category_distribution": quality.category_distribution(cleaned),
    }


def dashboard(
    spark: SparkSession,
    cleaned: DataFrame,
    load_path: str,
    country: str | None = None,
    period_from: str | None = None,
    period_to: str | None = None,
    products_only: bool = True,
    top_n: int = 10,
    rollup_path: str | None = None,
) -> dict[str, DataFrame]:
    """Every dashboard report over ``cleaned``; the typed table is written
    once to ``load_path`` (as the dashboard loads and caches it), the rollups
    that most reports share once under ``rollup_path`` (beside it if not given,
    under a new name: a table of the catalog refers to them)."""
    typed_df = write_and_reread(spark, load_table(cleaned), "typed", load_path)
    rollups = write_rollups(spark, sales(typed_df), rollup_path or f"{load_path.rstrip('/')}-rollups-{uuid.uuid4().hex[:12]}")
    r = Retail.from_typed(spark, typed_df, cleaned, rollups=rollups)
    sel = dict(country=country, period_from=period_from, period_to=period_to, products_only=products_only, default_from=r.activity)
    reports = {name: fn for name, fn in dashboard_queries().items() if not name.startswith(("slicer_metrics", "ticket_monthly", "slicer_top_products"))}
    own = {
        "country_pareto": countries.country_pareto(r.activity, top_n),
        "pareto_summary": countries.pareto_summary(r.activity, top_n),
        "pareto_table": countries.pareto_table(r.activity, top_n),
        "slicer_metrics": slicer.slicer_metrics(r.by_invoice, **sel),
        "ticket_monthly": slicer.ticket_monthly(r.by_invoice, **sel),
        "slicer_top_products": slicer.slicer_top_products(r.by_product, **sel),
    }
    skip = {"clean_retail", "returns_summary", "returns_impact", "customer_coverage", "customer_sales_share", "category_distribution", *own}
    return {name: fn(r) for name, fn in reports.items() if name not in skip} | own


def main(argv: list[str]) -> None:
    if len(argv) != 3:
        raise SystemExit("usage: python -m mercato.plans.jobs <raw.csv> <output_dir>")
    spark = SparkSession.builder.appName("mercato-cleaning-job").getOrCreate()
    for name, df in cleaning_job(spark, argv[1], argv[2]).items():
        print(f"== {name}")
        df.show(20, truncate=False)


if __name__ == "__main__":
    main(sys.argv)
