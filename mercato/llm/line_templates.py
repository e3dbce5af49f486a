"""Line dedup by a log-template tree (operator 1), DataFrame functions only.

Each line walks a tree of fixed depth: first its token count, then its first
``depth`` tokens, tokens with a digit counting as the wildcard ``<*>``. A line has
the template of its whole wording (its tokens with those wildcards), and one
learnt in its leaf: there each distinct wording counts once, and a token is
literal if two wordings or more have it at its place, and at least half
(one ``rare``-th) as many as have the median token of the line. The other tokens are variable fields and become wildcards too. So which places vary, and how many, is
taken from the corpus, for short lines as for long ones. A learnt template needs
three literal tokens that make up two thirds of the line.

A template that occurs in two documents or more is recurring. Its lines stay in
the document with the smallest id and are dropped from all others.

Lines are written once as 64-bit hashes of wording and leaf. Wordings are
pre-aggregated per task, so copies of a line weigh as one; only distinct wordings
of leaves that hold two or more, in two documents or more, are read again (each
from one document) and looked at token by token. No leaf is gathered anywhere: tokens are counted by leaf, place and token.
What is joined back is written first, so Spark knows its size, and splits hot
keys.

Defined results: a null text stays null; lines with fewer than two tokens always
stay; a line whose tokens are mostly wildcards is taken literally; a field among
the first ``depth`` tokens varies only by its digits; null ids count as one
document after all others; repeated rows are one document and get the same lines;
a document that loses all lines stays with an empty text; an empty table gives an
empty result. ``drop_recurring`` carries all other columns in one struct, so their
names cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.materialize import write_and_reread
from .tables import settled

WILDCARD = "<*>"
_NO_ID = (1 << 63) - 1


def _once(df: DataFrame, **made: Column) -> DataFrame:
    """``df`` with the columns ``made``, computed once a row even if a lambda refers to them: a projection would be
    inlined there and computed for each element, a generator is not."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in made.items()]))))


def _tokens(spaced: Column) -> Column:
    return F.array_remove(F.split(spaced, " "), "")


def generalised(lines: DataFrame) -> DataFrame:
    """``lines`` with ``tokens`` in place of ``line``: those with a digit become the wildcard if at most half have one."""
    line = F.col("line")
    rest = [c for c in lines.columns if c != "line"]
    other = F.contains(line, F.lit("\t")) | F.contains(line, F.lit("\r")) | F.contains(line, F.lit("\x0b")) | F.contains(line, F.lit("\x0c"))
    spaced = F.when(other, F.translate(line, "\t\x0b\x0c\r", "    ")).otherwise(line)
    masked = _tokens(F.regexp_replace("spaced", "(?<![^ ])[^ ]*[0-9][^ ]*", WILDCARD))
    split = lines.select(*rest, spaced.alias("spaced")).select(
        *rest, _tokens(F.col("spaced")).alias("plain"), F.when(F.col("spaced").rlike("[0-9]"), masked).alias("masked"))
    wild = F.size("masked") - F.size(F.array_remove("masked", WILDCARD))
    return split.select(*rest, F.when(wild * 2 <= F.size("masked"), F.col("masked")).otherwise(F.col("plain")).alias("tokens"))


def leaves(lines: DataFrame, depth: int) -> DataFrame:
    """``lines`` of two tokens or more with their ``leaf`` and ``wording``."""
    n = F.size("tokens")
    return lines.where(n >= 2).select("*", F.xxhash64(n, F.slice("tokens", 1, depth)).alias("leaf"), F.xxhash64("tokens").alias("wording"))


def learnt_templates(wordings: DataFrame, rare: int) -> DataFrame:
    """(__wording, template) of those ``wordings`` (wording, leaf, tokens as hashes) that have a learnt template."""
    places = wordings.select("wording", "leaf", F.size("tokens").alias("n"), F.posexplode("tokens").alias("place", "token"))
    places = places.withColumn("key", F.xxhash64("leaf", "place", "token"))
    frequent = places.groupBy("key").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    frequent = settled(frequent.withColumnRenamed("key", "__key"), "line_tokens")
    common = places.join(frequent, F.col("key") == F.col("__key")).groupBy("wording", "leaf", "n").agg(
        F.collect_list(F.struct("place", "token", "held")).alias("common"))
    # tokens of one wording only are the smallest counts, and too few here to hold the median
    middle = F.floor(F.col("n") / 2).cast("int") - F.col("n") + F.size("common")
    median = F.get(F.sort_array(F.col("common.held")), middle)
    common = _once(common.where(F.size("common") * 3 >= F.col("n") * 2), median=median)
    literal = F.filter("common", lambda x: (x["held"] * rare >= F.col("median")) & (x["token"] != F.xxhash64(F.lit(WILDCARD))))
    named = _once(common, literal=F.transform(F.sort_array(literal), lambda x: F.struct(x["place"], x["token"])))
    return named.where((F.size("literal") >= 3) & (F.size("literal") * 3 >= F.col("n") * 2)).select(
        F.col("wording").alias("__wording"), F.xxhash64("leaf", "literal").alias("template"))


def dropped_lines(docs: DataFrame, depth: int = 2, rare: int = 2, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, version, lines): line numbers (from 0) to drop, per document (id, null last) and text hash."""
    spark = docs.sparkSession
    content = F.col(f"`{text}`")
    hashed = docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(_NO_ID)).alias("doc"), F.xxhash64(content).alias("version"),
                         F.split(content, "\n", -1).alias("lines"))
    lines = hashed.select("doc", "version", F.posexplode("lines").alias("line_no", "line"))
    keys = write_and_reread(spark, leaves(generalised(lines), depth).drop("tokens"), "line_wordings")
    wordings = keys.groupBy("wording").agg(*[F.first(c).alias(c) for c in ("leaf", "doc", "version", "line_no")],  # of one row
                                           F.min("doc").alias("first_doc"), F.max("doc").alias("last_doc"))
    wordings = settled(wordings, "wordings")

    shared = wordings.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.min("first_doc").alias("lo"), F.max("last_doc").alias("hi"))
    shared = settled(shared.where("n > 1 and lo < hi").select(F.col("leaf").alias("__leaf")), "shared_leaves")
    picked = wordings.join(shared, F.col("leaf") == F.col("__leaf")).groupBy(F.col("doc").alias("__doc"), F.col("version").alias("__version")).agg(
        F.collect_list(F.struct("wording", "leaf", "line_no")).alias("picked"))
    picked = settled(picked, "picked_lines")
    again = _once(docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(_NO_ID)).alias("doc"), F.xxhash64(content).alias("version"),
                              content.alias("text")).join(picked, (F.col("doc") == F.col("__doc")) & (F.col("version") == F.col("__version"))),
                  lines=F.split("text", "\n", -1))
    again = again.select(F.inline(F.transform("picked", lambda x: F.struct(x["wording"], x["leaf"], F.get("lines", x["line_no"]).alias("line")))))
    again = generalised(again).groupBy("wording").agg(F.first("leaf").alias("leaf"), F.first("tokens").alias("tokens"))  # repeated rows
    again = again.select("wording", "leaf", F.transform("tokens", lambda t: F.xxhash64(t)).alias("tokens"))
    learnt = settled(learnt_templates(settled(again, "shared_wordings"), rare), "learnt_templates")

    learnt = wordings.join(learnt, F.col("wording") == F.col("__wording")).select("wording", "template", "first_doc", "last_doc")
    learnt = settled(learnt, "learnt_wordings")
    found = learnt.groupBy("template").agg(F.min("first_doc").alias("first_doc"), F.max("last_doc").alias("last_doc")).where("first_doc < last_doc")
    found = settled(found.select(F.col("template").alias("__template"), "first_doc"), "recurring_templates")
    firsts = learnt.select("wording", "template").join(found, F.col("template") == F.col("__template")).select("wording", "first_doc")
    firsts = wordings.where("first_doc < last_doc").select("wording", "first_doc").unionAll(firsts)
    firsts = settled(firsts.groupBy(F.col("wording").alias("__wording")).agg(F.min("first_doc").alias("first_doc")), "recurring_wordings")
    hits = keys.drop("leaf").join(firsts, F.col("wording") == F.col("__wording")).where("doc > first_doc")
    gone = hits.groupBy("doc", "version").agg(F.collect_set("line_no").alias("lines"))
    return settled(gone, "dropped_lines")


def drop_recurring(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options: int) -> DataFrame:
    """``docs`` with the recurring lines taken out of ``text``, and the numbers of lines before and dropped
    in a last column ``line_dedup`` (struct n_lines, n_dropped)."""
    gone = dropped_lines(docs, doc_id=doc_id, text=text, **options).withColumnsRenamed(
        {"doc": "__doc", "version": "__version", "lines": "__lines"}
    )
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"),
        F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(_NO_ID)).alias("__id"), F.xxhash64(F.col(f"`{text}`")).alias("__hash"),
    ).join(gone, (F.col("__id") == F.col("__doc")) & (F.col("__hash") == F.col("__version")), "left")
    old = F.col("__row")[text]
    rows, lines = _once(rows, __split=F.split(old, "\n", -1)), F.col("__split")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__lines"))
    new = F.when(F.col("__lines").isNull(), old).otherwise(F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n"))
    report = F.struct(
        F.when(old.isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.coalesce(F.size("__lines"), F.lit(0)).cast("long").alias("n_dropped"),
    )
    # size() of null is -1 in some sessions, so the report asks for null first
    report = F.struct(report["n_lines"].alias("n_lines"), F.when(F.col("__lines").isNull(), F.lit(0).cast("long")).otherwise(report["n_dropped"]).alias("n_dropped"))
    return rows.select(*[new.alias(c) if c == text else F.col("__row")[c].alias(c) for c in docs.columns], report.alias("line_dedup"))
