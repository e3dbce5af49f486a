"""Sources and sinks: raw/cleaned CSV, Parquet, the geo dimension and the
retail-shaped view over the test tables."""

from .files import (
    read_clean_csv,
    read_parquet,
    read_raw_csv,
    write_clean_csv,
    write_parquet,
    write_raw_csv,
)
from .fixture import retail_raw_view
from .geo import geo_dimension

__all__ = [
    "read_raw_csv",
    "write_raw_csv",
    "read_clean_csv",
    "write_clean_csv",
    "read_parquet",
    "write_parquet",
    "retail_raw_view",
    "geo_dimension",
]
