"""Incremental execution of the cleaning job with Structured Streaming.

The reference workload is batch only (no streams, watermarks or state). The
one place where streaming is the natural Spark form is the cleaning job on a
landing folder that keeps receiving raw CSV files: ``clean_incrementally``
runs the very same ``clean`` projection over a file stream and appends
Parquet, with the checkpoint giving exactly-once output across restarts and
lost executors. No other streaming operator is provided.
"""

from .clean_stream import clean_incrementally

__all__ = ["clean_incrementally"]
