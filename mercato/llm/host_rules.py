"""Quality rules judged with the help of the host (operator 10).

Each text is measured once (words, symbols, repeated lines, repeated three-word
windows). Rules that a text breaks mildly count against it only where its host
breaks the same rule often: failures are summed by host, the rates are shrunk
with a beta prior fitted to all hosts (empirical Bayes, by moments), and the
hosts' verdicts are joined back to the documents.

Defined results: a null text has no words and fails the base rule; a null
source is a host of its own; repeated rows are judged alike; an empty table
gives an empty result. Inputs may carry any further columns, also ones named
like those made here: ``measure`` takes only what it is told to keep, and
``filter_documents`` carries the whole row in one struct.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.materialize import write_and_reread
from .tables import settled
from .words import per_run, steps, tokenise

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


@dataclass(frozen=True)
class Rules:
    """Thresholds. A mild failure counts only with the host's verdict; a severe one always."""

    min_words: int = 50
    max_repeat_pct: int = 50  # words in repeated three-word windows
    symbols_pct: int = 10  # symbols per 100 words: mild
    symbols_severe_pct: int = 100
    dup_lines_pct: int = 30  # lines equal to an earlier one: mild
    min_word_len: int = 3  # mean code points per word: mild outside
    max_word_len: int = 10
    host_rate: float = 0.5  # shrunk failure rate from which a host's mild failures count


SOFT = ["symbols", "dup_lines", "word_len"]


def _measure_texts(texts: list[bytes]) -> dict[str, np.ndarray]:
    ids, uniq, lens = tokenise(texts)
    n, v = len(ids), max(len(uniq), 1)
    repeated = np.zeros(n, np.int64)
    if n >= 3:
        doc = np.repeat(np.arange(len(lens)), lens)
        first = np.flatnonzero(doc[:-2] == doc[2:])
        if v < 1 << 21:  # three ids fit one 64-bit key
            key = (ids[first] * v + ids[first + 1]) * v + ids[first + 2]
        else:
            _, pair = np.unique(ids[first] * v + ids[first + 1], return_inverse=True)
            key = pair.astype(np.int64) * v + ids[first + 2]
        order = np.argsort(key, kind="stable")  # equal keys keep text order, so a document's are adjacent
        at, k = first[order], key[order]
        same = (k[1:] == k[:-1]) & (doc[at[1:]] == doc[at[:-1]])
        hit = np.zeros(len(k), bool)
        hit[1:] |= same
        hit[:-1] |= same
        for i in range(3):
            repeated[at[hit] + i] = 1
    spaces = [len(t) - len(t.translate(None, SPACES)) for t in texts]
    lines = [[x for x in t.split(b"\n") if x.strip()] for t in texts]
    return {
        "n_words": lens,
        "word_chars": np.array([len(t.decode("utf-8", "replace")) - s for t, s in zip(texts, spaces, strict=True)], np.int64),
        "n_symbols": np.array([len(t) - len(t.translate(None, SYMBOLS)) for t in texts], np.int64),
        "n_lines": np.array([len(x) for x in lines], np.int64),
        "n_dup_lines": np.array([len(x) - len(set(x)) for x in lines], np.int64),
        "n_repeat_words": per_run(repeated, lens),
    }


def _measure_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rest = [batch.column(i) for i in range(1, batch.num_columns)]
        names = batch.schema.names[1:]
        for a, b, texts in steps(batch.column(0)):
            got = _measure_texts(texts)
            yield pa.RecordBatch.from_arrays(
                [c.slice(a, b - a) for c in rest] + [pa.array(got[m], pa.int64()) for m in MEASURES], names + MEASURES
            )


def measure(docs: DataFrame, text: str = "text", **keep: Column) -> DataFrame:
    """One row per document: the columns named in ``keep`` and the measures."""
    src = docs.select(F.col(f"`{text}`").alias("__text"), *[c.alias(n) for n, c in keep.items()])
    schema = T.StructType(list(src.schema.fields[1:]) + [T.StructField(m, T.LongType()) for m in MEASURES])
    return src.mapInArrow(_measure_batches, schema)


def failures(r: Rules) -> dict[str, Column]:
    """Each rule as a boolean column over the measures."""
    n = F.col("n_words")
    base = (n < r.min_words) | (F.col("n_repeat_words") * 100 > n * r.max_repeat_pct)
    return {
        "base_failed": base,
        "severe": F.col("n_symbols") * 100 > n * r.symbols_severe_pct,
        "symbols": F.col("n_symbols") * 100 > n * r.symbols_pct,
        "dup_lines": F.col("n_dup_lines") * 100 > F.col("n_lines") * r.dup_lines_pct,
        "word_len": (F.col("word_chars") < n * r.min_word_len) | (F.col("word_chars") > n * r.max_word_len),
    }


def host_verdicts(measured: DataFrame, r: Rules = Rules(), host: str = "host") -> DataFrame:
    """One row per host: documents, and for each mild rule the shrunk failure rate.

    The prior of a rule is a beta with the mean of all documents and the
    variance between hosts that is left after the sampling variance. The prior
    comes from one aggregated row per rule; the hosts themselves stay distributed.
    """
    rules = failures(r)
    hosts = measured.groupBy(F.col(host)).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(rules[s].cast("long")).alias(s) for s in SOFT]
    )
    hosts = settled(hosts, "host_failures")
    fit = hosts.agg(
        F.count(F.lit(1)).alias("k"),
        F.sum("n").alias("n"),
        F.avg(1 / F.col("n")).alias("inv"),
        *[F.sum(s).alias(s) for s in SOFT],
        *[F.var_pop(F.col(s) / F.col("n")).alias(f"{s}_var") for s in SOFT],
    ).first()
    out = [F.col(host), F.col("n")]
    for s in SOFT:
        mean = fit[s] / fit["n"] if fit["n"] else 0.0
        spread = mean * (1 - mean)
        between = (fit[f"{s}_var"] or 0.0) - spread * (fit["inv"] or 0.0)
        strength = min(max(spread / between - 1, 1.0), 1e6) if between > 0 else 1e6
        out.append(((F.col(s) + mean * strength) / (F.col("n") + strength)).alias(f"{s}_rate"))
    return hosts.select(*out)


def judge(measured: DataFrame, r: Rules = Rules(), host: str = "host") -> DataFrame:
    """``measured`` with ``base_failed`` and ``kept``.

    The host table is written first, so Spark knows its size: it broadcasts it
    under its threshold and else splits hot hosts in the sort-merge join.
    """
    hosts = settled(host_verdicts(measured, r, host), "host_verdicts")
    hosts = hosts.select(F.col(host).alias("__host"), *[F.col(f"{s}_rate").alias(f"__{s}") for s in SOFT])
    rules = failures(r)
    mild = F.lit(False)
    for s in SOFT:
        mild = mild | (rules[s] & (F.coalesce(F.col(f"__{s}"), F.lit(0.0)) >= r.host_rate))
    joined = measured.join(hosts, F.col(host).eqNullSafe(F.col("__host")), "left")
    return joined.select(
        *measured.columns, rules["base_failed"].alias("base_failed"),
        (~(rules["base_failed"] | rules["severe"] | mild)).alias("kept"),
    )


def filter_documents(docs: DataFrame, r: Rules = Rules(), text: str = "text", host: str = "source") -> DataFrame:
    """The documents that are kept, with all their columns.

    They are written with their measures before they are judged: hosts and documents then read the same measures.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    measured = write_and_reread(docs.sparkSession, measure(docs, text, row=row, host=F.col(f"`{host}`")), "measured_documents")
    return judge(measured, r).where("kept").select("row.*")
