"""The in-line country centroid dimension (S6): a literal, so its size is fixed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schema import COUNTRY_CENTROIDS, GEO


def geo_dimension(spark: SparkSession, rows=None) -> DataFrame:
    return spark.createDataFrame(list(rows if rows is not None else COUNTRY_CENTROIDS), GEO)
