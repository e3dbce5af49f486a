"""Registered queries of the corpus operators: each over its whole table."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.materialize import write_and_reread
from ..session import scratch_path
from . import (
    bpe,
    curriculum,
    decontaminate,
    disclosure,
    host_rules,
    jaccard_join,
    licenses,
    line_templates,
    pitman_yor,
    runs,
    warc_store,
    whitening,
    window_dedup,
)

QueryFn = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each text and how many are dropped as recurring templates; kept_sha256 is of the new text."""
    out = line_templates.drop_recurring(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "line_dedup.n_lines", "line_dedup.n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = window_dedup.remove_repeats(table(spark, sf_dir, "documents"), doc_id=F.col("doc_id"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = disclosure.find_spans(table(spark, sf_dir, "documents"))
    kinds = disclosure.KINDS
    return found.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in kinds],
        F.sha2(disclosure.spans_text(kinds).cast("binary"), 256).alias("base_sha256"),
        disclosure.spans_text([*kinds, "term"]).alias("spans"),
    )


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through the archive; ``record_sha256`` is of the whole record, rebuilt from header and payload."""
    path = scratch_path(spark, "warc")
    warc_store.write_archive(table(spark, sf_dir, "pages"), path)
    return warc_store.read_archive(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", F.sha2("record", 256).alias("record_sha256")
    )


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item that it contains."""
    return decontaminate.find_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.scores(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = curriculum.plan(table(spark, sf_dir, "documents"))
    return planned.select(
        "doc_id", "size", "source_size", "target", "taken",
        F.floor(F.try_element_at("positions", F.lit(1)) * 1_000_000).cast("long").alias("first_position_ppm"),
    )


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as files of a tree: source / language / id."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.coalesce("lang", F.lit("unknown")), F.col("doc_id").cast("string"))
    return licenses.scan(docs, path, F.col("text"), doc_id=F.col("doc_id"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    measured = host_rules.measure(docs, doc_id=F.col("doc_id"), host=F.col("source"))
    measured = write_and_reread(spark, measured, "measures")
    return host_rules.judge(measured).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded again; the digests are of the packed ids and the decoded text."""
    encoded = bpe.encode(table(spark, sf_dir, "documents"), doc_id=F.col("doc_id"))
    decoded = bpe.decode(encoded.withColumn("ids_sha256", F.sha2("ids", 256)))
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whitening.whiten(table(spark, sf_dir, "embeddings"), vec_id=F.col("vec_id"))
    return out.select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


def planted_period(columns: dict) -> runs.Rewrite:
    """The contract's periodic texts: for one in ten hashes of the id, words from number a on repeat with period p."""
    ids = columns["doc_id"]

    def change(row: int, words: list[bytes]) -> list[bytes]:
        h = 1 if ids[row] is None else zlib.crc32(str(ids[row]).encode())
        if h % 10 or not words:
            return words
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]

    return change


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.find_runs(table(spark, sf_dir, "documents"), rewrite=planted_period, doc_id=F.col("doc_id"))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def queries() -> dict[str, QueryFn]:
    return {
        "op1_line_dedup": op1_line_dedup,
        "op2_substring_dedup": op2_substring_dedup,
        "op3_pii": op3_pii,
        "op4_warc": op4_warc,
        "op5_decontamination": op5_decontamination,
        "op6_lm_scoring": op6_lm_scoring,
        "op7_mixing": op7_mixing,
        "op8_licenses": op8_licenses,
        "op9_jaccard_join": op9_jaccard_join,
        "op10_quality_rules": op10_quality_rules,
        "op11_bpe": op11_bpe,
        "op12_whitening": op12_whitening,
        "op13_periodic_runs": op13_periodic_runs,
    }
