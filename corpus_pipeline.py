"""Corpus pipeline: quality rules, line dedup, near-duplicate join, decontamination, mixing.

``STAGES`` lists the stages in order; each takes (spark, docs, sf_dir) and works
on all that its predecessor kept. ``run`` applies them to ``documents``, each
result being written under the shared checkpoint folder and read again. All but
the last stage return the columns of ``documents``; the last returns the
training order, one row per document and epoch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from mercato.llm import curriculum, decontaminate, host_rules, jaccard_join, line_templates
from mercato.llm.tables import settled
from mercato.operators.materialize import write_and_reread


#: Words of a shingle and percent of similarity from which on documents are near-duplicates.
NEAR_WORDS, NEAR_PCT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return host_rules.filter_documents(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of recurring templates go from all documents but the first; ``n_chars`` follows the text."""
    out = line_templates.drop_recurring(docs).drop("line_dedup")
    return out.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays (null last).

    Near-duplicates are texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.
    A text without words is in no group and stays. Rows that share an id are
    told apart by their text; of equal rows one stays.
    """
    ident, version = F.coalesce("doc_id", F.lit(2**63 - 1)), F.xxhash64("text")
    found = jaccard_join.near_duplicates(docs, k=NEAR_WORDS, pct=NEAR_PCT, version=version).where("group_id is not null")
    lead = found.groupBy("group_id").agg(F.min(F.struct(ident.alias("__id"), F.col("version").alias("__text"))).alias("lead"))
    lead = settled(lead.select("lead.*"), "near_leads")
    rows = docs.select(F.struct(*docs.columns).alias("row"), ident.alias("id"), version.alias("version"),
                       F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]").alias("has_words"))
    kept = rows.where("has_words").join(lead, (F.col("id") == F.col("__id")) & (F.col("version") == F.col("__text")))
    kept = kept.withColumn("nth", F.row_number().over(W.partitionBy("__id", "__text").orderBy("row"))).where("nth = 1")
    return kept.select("row.*").unionAll(rows.where("not has_words").select("row.*"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training order: doc_id, source, size, epoch, position (range-sorted)."""
    return curriculum.training_order(curriculum.plan(docs))


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: The decontamination stage cannot be put in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = write_and_reread(spark, stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
