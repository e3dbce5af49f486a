"""Information-theoretic sanitisation of personal data (operator 3), DataFrame functions only.

Protected entities are the personal data that patterns find: e-mail addresses,
IP addresses, card numbers and phone numbers (the base spans). Which other terms
give an entity away is learnt from the corpus: over all its areas, a term t
discloses the share PMI(t; e) / IC(e) of an entity's information, where
IC(e) = -log2 p(e) and PMI(t; e) = log2 p(t, e) / (p(t) p(e)). An area is a
document or, in one of more than 32 lines, each run of 32 lines that starts 16
lines after the last, so terms and entities meet across line ends. A term that
meets an entity in ``min_lines`` different areas or more and discloses
``remove_share`` of it is removed where it occurs, one that discloses
``generalise_share`` is generalised. Copies of one area are not different, so
repeated documents disclose nothing by themselves. Words that overlap a base
span are no terms there; all others are, with digits or without.

The terms of each area are written once. Counts are pre-aggregated per task. The
entities that can have a disclosing term, the terms to be counted, and then the
disclosing ones, are written before they are joined, so Spark knows their size.

A pattern cannot match a line feed, so areas hold the same spans as the text.

Defined results: a null text is empty; empty texts have no spans; repeated rows
have the same spans; an empty table gives an empty result; ties cannot occur
(spans of a kind do not overlap). Rows are keyed by id and text hash; null ids
are an id of their own. Only the id, the text and the columns in ``keep`` are read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.materialize import write_and_reread
from .tables import settled

KINDS = ["email", "ip", "card", "phone"]

# The base patterns.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

# The same matches without backtracking, so that no text is too long for them: possessive, since no quantifier is
# followed by a character that it takes, and anchored to the start of a run or the end of the last match, since a match
# within a run would have started with it. For cards only runs of 16 to 19 digits are found: others fail the check of
# the length, and a text of many numbers has few that pass it.
_SEARCH = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){15,18}+(?![\x20-]?[0-9])",
    "phone": PHONE,
}
_MAY_HAVE = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_RUN = 32  # lines
_SPANS = "array<struct<start:bigint,end:bigint,value:string>>"


@dataclass(frozen=True)
class Thresholds:
    min_lines: int = 3
    generalise_share: float = 0.6
    remove_share: float = 0.85


def _placed(items: Column, value: Callable[[Column], Column], join: Callable[[Column, Column], Column]) -> Column:
    """Array of (at, item): ``at`` is what the BIGINT values of the items before make together, their sum or the
    greatest, and 0 for none.

    Items are taken in blocks of about the square root of their number, and then the blocks, so that a text of n items
    copies n * sqrt(n) numbers and not n * n. The items are bound by a lambda, so that they are made once.
    """

    def walk(array: Column, one: Callable[[Column], Column]) -> Column:
        start = F.struct(F.lit(0).cast("bigint").alias("now"), F.array().cast("array<bigint>").alias("out"))
        return F.aggregate(array, start, lambda acc, x: F.struct(
            join(acc["now"], one(x)).alias("now"), F.concat(acc["out"], F.array(acc["now"])).alias("out")))

    def before(bound: Column) -> Column:
        size = F.ceil(F.sqrt(F.size(bound))).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), F.ceil(F.size(bound) / size).cast("int") - 1), lambda k: walk(F.slice(bound, k * size + 1, size), value))
        return _let(blocks, lambda b: F.flatten(F.transform(
            F.arrays_zip(b.alias("own"), walk(b, lambda block: block["now"])["out"].alias("ahead")),
            lambda x: F.transform(x["own"]["out"], lambda own: join(x["ahead"], own)))))

    def zipped(bound: Column) -> Column:
        at = F.when(F.size(bound) == 0, F.array().cast("array<bigint>")).otherwise(before(bound))
        return F.arrays_zip(at.alias("at"), bound.alias("item"))

    return _let(items, zipped)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is made once however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _sum(a: Column, b: Column) -> Column:
    return a + b


def _matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches with their code point offsets: what lies between them comes from split()."""
    between, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = F.filter(F.arrays_zip(between.alias("gap"), found.alias("value")), lambda x: x["value"].isNotNull())
    sized = F.transform(both, lambda x: F.struct(
        F.length(x["gap"]).cast("bigint").alias("gap"), F.length(x["value"]).cast("bigint").alias("own"), x["value"].alias("value")))
    start = lambda x: x["at"] + x["item"]["gap"]
    return F.transform(_placed(sized, lambda x: x["gap"] + x["own"], _sum), lambda x: F.struct(
        start(x).alias("start"), (start(x) + x["item"]["own"]).alias("end"), x["item"]["value"].alias("value")))


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def worth(i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).otherwise(F.when(d > 4, d * 2 - 9).otherwise(d * 2))

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda acc, i: acc + worth(i)) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: p.cast("double") <= 255)
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(8, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    """Array of (start, end, value) of one kind; empty for null."""
    found = F.when(text.rlike(_MAY_HAVE[kind]), _matches(text, _SEARCH[kind])).otherwise(F.array().cast(_SPANS))
    return F.filter(found, lambda x: _valid(kind, x["value"]))


def _entities(spans: Column, kind: str) -> Column:
    """The entities of one kind, written alike wherever they occur."""

    def entity(x: Column) -> Column:
        same = F.lower(x["value"]) if kind == "email" else x["value"] if kind == "ip" else F.regexp_replace(x["value"], "[^0-9]", "")
        return F.concat(F.lit(f"{kind}:"), same)

    return F.transform(spans, entity)


def term_of(word: Column) -> Column:
    """A lower-case word without ASCII punctuation at its ends."""
    return F.btrim(word, F.lit(_PUNCTUATION))


def _outside(text: Column, spans: Column) -> Column:
    """The text with spaces for its white space and a line feed for each base span."""
    spaced = F.translate(text, "\t\n\x0b\x0c\r", "     ")
    after = _placed(F.array_sort(spans), lambda x: x["end"], F.greatest)
    gaps = F.transform(F.filter(after, lambda x: x["item"]["start"] >= x["at"]),
                       lambda x: F.substring(spaced, (x["at"] + 1).cast("int"), (x["item"]["start"] - x["at"]).cast("int")))
    rest = F.substring(spaced, (F.array_max(F.transform(spans, lambda x: x["end"])) + 1).cast("int"), F.length(spaced))
    return F.when(F.size(spans) == 0, spaced).otherwise(F.array_join(F.concat(gaps, F.array(rest)), "\n"))


def _terms(outside: Column) -> Column:
    """The distinct terms, without the words that overlap a base span, and the empty one (so that it counts areas)."""
    words = F.filter(F.split(F.lower(outside), " "), lambda w: ~F.contains(w, F.lit("\n")))
    return F.array_distinct(F.concat(F.transform(words, term_of), F.array(F.lit(""))))


def _areas(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc, version, area_hash, area): the document, or if it is longer overlapping runs of ``_RUN`` lines."""
    content, lines = F.col(f"`{text}`"), F.col("lines")
    split = docs.select(F.col(f"`{doc_id}`").alias("doc"), F.xxhash64(content).alias("version"), F.split(content, "\n", -1).alias("lines"))
    last = F.greatest(F.lit(0), F.ceil((F.size(lines) - _RUN) / (_RUN // 2)).cast("int"))
    runs = split.where(lines.isNotNull()).withColumn("run", F.explode(F.sequence(F.lit(0), last)))
    area = F.array_join(F.slice(lines, F.col("run") * (_RUN // 2) + 1, F.lit(_RUN)), "\n")
    return runs.select("doc", "version", area.alias("area")).withColumn("area_hash", F.xxhash64("area"))


def disclosing_terms(docs: DataFrame, limits: Thresholds = Thresholds(), doc_id: str = "doc_id",
                     text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(term, share) of the terms over the lower threshold, and (doc, version, term) where they occur."""
    spark = docs.sparkSession
    areas = _areas(docs, doc_id, text).withColumns({k: base_spans(F.col("area"), k) for k in KINDS})
    areas = areas.select("doc", "version", "area_hash", F.array_distinct(F.concat(*[_entities(F.col(k), k) for k in KINDS])).alias("entities"),
                         _terms(_outside(F.col("area"), F.concat(*KINDS))).alias("terms"))
    areas = write_and_reread(spark, areas, "pii_areas")

    # An entity in fewer different areas than a term has to meet it in has no disclosing term.
    mentions = areas.select("area_hash", "terms", F.explode("entities").alias("entity"))
    n_entity = mentions.groupBy("entity", "area_hash").agg(F.count(F.lit(1)).alias("n")).groupBy("entity").agg(
        F.sum("n").alias("n_entity"), F.count(F.lit(1)).alias("areas")).where(F.col("areas") >= limits.min_lines).drop("areas")
    n_entity = settled(n_entity, "pii_entities")
    known = mentions.join(n_entity.select(F.col("entity").alias("__entity")), F.col("entity") == F.col("__entity"))
    meet = known.select("entity", "area_hash", F.explode("terms").alias("term")).where("term <> ''")
    meet = meet.groupBy("entity", "term", "area_hash").agg(F.count(F.lit(1)).alias("n")).groupBy("entity", "term").agg(
        F.sum("n").alias("n_both"), F.count(F.lit(1)).alias("different")).where(F.col("different") >= limits.min_lines)
    meet = settled(meet.join(n_entity, "entity"), "pii_pairs")

    words = areas.select("doc", "version", F.explode("terms").alias("term"))
    asked = meet.select(F.col("term").alias("__term")).unionAll(spark.createDataFrame([("",)], "__term string")).distinct()
    asked = settled(asked, "pii_terms")
    n_term = words.join(asked, F.col("term") == F.col("__term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_term"))
    n_term = settled(n_term, "pii_term_counts")
    areas_row = n_term.where("term = ''").first()
    total = float(areas_row["n_term"]) if areas_row else 0.0

    pmi = F.log2(F.col("n_both") * F.lit(total) / (F.col("n_term") * F.col("n_entity")))
    share = F.try_divide(pmi, F.log2(F.lit(total) / F.col("n_entity")))
    found = meet.join(n_term, "term").groupBy("term").agg(F.max(share).alias("share")).where(F.col("share") >= limits.generalise_share)
    found = settled(found, "pii_disclosing")
    where = words.join(found.select(F.col("term").alias("__term")), F.col("term") == F.col("__term"))
    return found, where.select("doc", "version", "term").distinct()


def find_spans(docs: DataFrame, limits: Thresholds = Thresholds(), doc_id: str = "doc_id", text: str = "text",
               **keep: Column) -> DataFrame:
    """One row per document: doc_id, the columns in ``keep``, ``email``, ``ip``, ``card``, ``phone`` and ``term``
    (arrays of start, end, value; a term's value is what it becomes), and ``text``."""
    spark = docs.sparkSession
    found, occur = disclosing_terms(docs, limits, doc_id, text)
    becomes = F.when(F.col("share") >= limits.remove_share, F.lit("")).otherwise(F.lit("<term>"))
    where = occur.join(found.select(F.col("term").alias("__term"), becomes.alias("becomes")), F.col("term") == F.col("__term"))
    per_doc = where.groupBy("doc", "version").agg(F.map_from_entries(F.collect_set(F.struct("term", "becomes"))).alias("__terms"))
    per_doc = settled(per_doc, "pii_by_document").withColumnsRenamed({"doc": "__doc", "version": "__version"})

    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    src = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), *[c.alias(n) for n, c in keep.items()], content.alias("text"),
                      F.xxhash64(F.col(f"`{text}`")).alias("__hash"))
    rows = src.join(per_doc, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("__hash") == F.col("__version")), "left")
    words = F.split(F.col("text"), r"[\x20\x09-\x0D]", -1)
    to = lambda w: F.try_element_at(F.col("__terms"), term_of(F.lower(w)))
    placed = F.filter(_placed(words, lambda w: F.length(w).cast("bigint") + 1, _sum), lambda x: to(x["item"]).isNotNull())
    term = F.when(F.col("__terms").isNull(), F.array().cast(_SPANS)).otherwise(F.transform(placed, lambda x: F.struct(
        x["at"].alias("start"), (x["at"] + F.length(x["item"])).alias("end"), to(x["item"]).alias("value"))))
    spans = rows.select("doc_id", *keep, *[base_spans(F.col("text"), k).alias(k) for k in KINDS], term.alias("term"), "text")
    base = F.concat(*KINDS)
    clear = F.filter("term", lambda w: ~F.exists(base, lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"])))
    return spans.withColumn("term", F.when(F.size("term") > 0, clear).otherwise(F.col("term")))


def spans_text(kinds: list[str]) -> Column:
    """kind:start:end of the span columns, by kind as listed and then start, comma-joined."""

    def written(kind: str) -> Column:
        return F.transform(F.col(kind), lambda x: F.concat(F.lit(f"{kind}:"), x["start"].cast("string"), F.lit(":"), x["end"].cast("string")))

    return F.array_join(F.concat(*[written(k) for k in kinds]), ",")


def sanitised(spans: DataFrame) -> DataFrame:
    """``find_spans`` with the text in which base spans became ``<kind>`` and terms what they become.

    Of spans that overlap, the first (of those that start alike the longest) stands for all; the text under them goes.
    """

    def marked(kind: str) -> Column:
        return F.transform(F.col(kind), lambda x: F.struct(
            x["start"].alias("start"), (-x["end"]).alias("minus_end"), (x["value"] if kind == "term" else F.lit(f"<{kind}>")).alias("to")))

    marks = F.concat(*[marked(k) for k in [*KINDS, "term"]])
    kept = F.filter(_placed(F.array_sort(marks), lambda x: -x["minus_end"], F.greatest), lambda x: x["item"]["start"] >= x["at"])
    pieces = F.flatten(F.transform(kept, lambda x: F.array(
        F.substring(F.col("text"), (x["at"] + 1).cast("int"), (x["item"]["start"] - x["at"]).cast("int")), x["item"]["to"])))
    last = F.coalesce(F.array_max(F.transform(marks, lambda x: -x["minus_end"])), F.lit(0).cast("bigint"))
    rest = F.substring(F.col("text"), (last + 1).cast("int"), F.length("text"))
    return spans.withColumn("text", F.concat(F.array_join(pieces, ""), rest))
