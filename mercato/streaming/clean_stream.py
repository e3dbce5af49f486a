"""File-stream version of the cleaning job (same projection, appended output)."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.clean import clean
from ..schema import CLEAN_COLUMNS, RAW
from ..sources.files import CSV_SEP


def clean_incrementally(
    spark: SparkSession,
    landing_dir: str,
    output_dir: str,
    checkpoint_dir: str,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Clean every raw CSV file that lands in ``landing_dir`` into Parquet.

    ``available_now=True`` processes what is there and stops (a scheduled
    batch run that only reads new files); otherwise it keeps running.
    """
    reader = (
        spark.readStream.schema(RAW)
        .option("header", True)
        .option("sep", CSV_SEP)
        .option("encoding", "UTF-8")
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    cleaned = clean(reader.csv(landing_dir)).select(*CLEAN_COLUMNS)
    writer = (
        cleaned.writeStream.format("parquet")
        .option("path", output_dir)
        .option("checkpointLocation", checkpoint_dir)
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
