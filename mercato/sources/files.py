"""File sources and sinks: raw/cleaned CSV and Parquet.

* S1 ``read_raw_csv``: the ``;``-separated raw file with a declared schema.
* S2 ``read_clean_csv``: the exported cleaned CSV.
* S3 ``write_parquet`` / S5 ``read_parquet``: columnar export and re-read.
* S4 ``write_clean_csv``: the CSV export. By default one file per task (it
  scales); ``single_file=True`` funnels everything through one task, which is
  only sensible for small exports (it is what a BI tool wants).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schema import CLEAN, RAW

CSV_SEP = ";"


def read_raw_csv(spark: SparkSession, path: str, schema=RAW) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", CSV_SEP)
        .option("encoding", "UTF-8")
        .csv(path)
    )


def write_raw_csv(df: DataFrame, path: str) -> None:
    """Write raw lines as the source file looks: padding kept, ``;``, header."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("sep", CSV_SEP)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_clean_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV export of the cleaned table (Spark's writer defaults: outer spaces
    are stripped, empty text is written as ``""`` and reads back as NULL)."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).option("sep", CSV_SEP).csv(path)


def read_clean_csv(spark: SparkSession, path: str, schema=CLEAN) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("sep", CSV_SEP).csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
