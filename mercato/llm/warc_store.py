"""Content-addressed WARC archive (operator 4).

``write_archive`` makes one WARC record per page and writes two tables: the
payloads, each stored once under its SHA-256 (packed with zstd), and the exact
record headers. ``read_archive`` joins them again and returns the records byte
for byte; every payload it hands out is checked against its digest and length,
and a mismatch is an error.

Of the records with equal payloads of ``min_revisit_bytes`` or more, the one
with the smallest page id is the response and the others are revisits of it.
The writer sends one copy of each payload per task and the join's hot digests
are split by Spark (both sides are files), so a payload that a third of all
pages share meets no single task.

Defined results: a null html is an empty payload; a null url is an empty target;
null page ids come after all others; of repeated rows with the smallest page id
one (by url) is the response and the rest revisit it; an empty table gives an
empty archive. Only the three columns named are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import scratch_path
from .words import steps

REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "


def _digest(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packer = zstandard.ZstdCompressor(level=3)
    for rows in stream:
        for a, b, payloads in steps(rows.column(2)):
            part = rows.slice(a, b - a)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array([hashlib.sha256(p).hexdigest() for p in payloads], pa.string()),
                 pa.array([len(p) for p in payloads], pa.int64()), pa.array([packer.compress(p) for p in payloads], pa.binary())],
                ["page_id", "url", "payload_digest", "payload_bytes", "packed"],
            )


def _unpack(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    opener = zstandard.ZstdDecompressor()
    for rows in stream:
        for a in range(0, rows.num_rows, 500):
            part = rows.slice(a, 500)
            payloads = [opener.decompress(x) for x in part.column("packed").to_pylist()]
            names = [n for n in part.schema.names if n != "packed"]
            yield pa.RecordBatch.from_arrays([*[part.column(n) for n in names], pa.array(payloads, pa.binary())], [*names, "payload"])


def _record_id(digest: Column, page: Column, nth: Column) -> Column:
    h = F.md5(F.concat_ws(":", digest, F.coalesce(page.cast("string"), F.lit("null")), nth.cast("string")))
    return F.concat(F.lit("<urn:uuid:"), F.regexp_replace(h, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"), F.lit(">"))


def write_archive(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html",
                  min_revisit_bytes: int = 100, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write ``path/payloads`` and ``path/records``. ``date`` is the WARC-Date of the records."""
    spark = pages.sparkSession
    src = pages.select(F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{url}`").alias("url"), F.col(f"`{html}`").alias("html"))
    hashed = src.mapInArrow(_digest, "page_id long, url string, payload_digest string, payload_bytes long, packed binary")
    staged = scratch_path(spark, "warc_digests")  # each payload is digested and packed once
    hashed.write.option("compression", "uncompressed").parquet(staged)
    hashed = spark.read.parquet(staged)
    hashed.groupBy("payload_digest").agg(
        F.first("payload_bytes").alias("payload_bytes"), F.min("page_id").alias("first_page"), F.first("packed").alias("packed")
    ).write.option("compression", "uncompressed").parquet(f"{path}/payloads")

    firsts = spark.read.parquet(f"{path}/payloads").select(F.col("payload_digest").alias("__digest"), "first_page")
    rows = hashed.drop("packed").join(firsts, F.col("payload_digest") == F.col("__digest")).drop("__digest")
    same = W.partitionBy("payload_digest", "page_id").orderBy("url")
    rows = rows.withColumn("nth", F.row_number().over(same))
    first = F.col("page_id").eqNullSafe(F.col("first_page")) & (F.col("nth") == 1)
    revisit = (F.col("payload_bytes") >= min_revisit_bytes) & ~first
    target = F.replace(F.replace(F.coalesce("url", F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    http = F.concat(F.lit(HTTP), F.col("payload_bytes").cast("string"), F.lit("\r\n\r\n"))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.col("record_type"),
        F.lit("\r\nWARC-Record-ID: "), _record_id(F.col("payload_digest"), F.col("page_id"), F.col("nth")),
        F.lit("\r\nWARC-Target-URI: "), target, F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Payload-Digest: sha256:"), F.col("payload_digest"),
        F.when(F.col("record_type") == "revisit", F.concat(
            F.lit(f"\r\nWARC-Profile: {REVISIT_PROFILE}\r\nWARC-Refers-To: "),
            _record_id(F.col("payload_digest"), F.col("first_page"), F.lit(1)),
        )).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        (F.length(http) + F.when(F.col("record_type") == "revisit", F.lit(0)).otherwise(F.col("payload_bytes"))).cast("string"),
        F.lit("\r\n\r\n"), http,
    )
    rows.withColumn("record_type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))).select(
        "page_id", "url", "payload_digest", "payload_bytes", "record_type",
        F.when(F.col("record_type") == "revisit", F.col("first_page")).alias("refers_to"), head.cast("binary").alias("header"),
    ).write.option("compression", "zstd").parquet(f"{path}/records")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: page_id, url, record_type, refers_to, payload (the full one, for revisits too),
    payload_digest and payload_bytes (both taken from the payload read) and ``record``, the record's bytes."""
    records = spark.read.parquet(f"{path}/records")
    payloads = spark.read.parquet(f"{path}/payloads").select(F.col("payload_digest").alias("__digest"), "packed")
    joined = records.join(payloads, F.col("payload_digest") == F.col("__digest"), "left").drop("__digest")
    missing = F.raise_error(F.concat(F.lit("no payload for digest "), F.col("payload_digest")))
    joined = joined.withColumn("packed", F.coalesce("packed", missing.cast("binary")))
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in joined.schema.fields if f.name != "packed"]
    opened = joined.mapInArrow(_unpack, ", ".join([*fields, "payload binary"])).withColumnsRenamed(
        {"payload_digest": "__digest", "payload_bytes": "__bytes"}
    )
    found = F.sha2("payload", 256)
    sound = (found == F.col("__digest")) & (F.octet_length("payload") == F.col("__bytes"))
    wrong = F.raise_error(F.concat(F.lit("payload does not match digest "), F.col("__digest")))
    body = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return opened.select(
        "page_id", "url", "record_type", "refers_to", "payload",
        F.when(sound, found).otherwise(wrong.cast("string")).alias("payload_digest"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.concat("header", body, F.lit(b"\r\n\r\n")).alias("record"),
    )
