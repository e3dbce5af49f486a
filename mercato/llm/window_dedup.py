"""Removal of repeated word windows (operator 2).

Every window of ``window`` consecutive words of every document gets a
Rabin-Karp hash; Spark counts the hashes over the whole corpus (see
exchange.py); each word under a window that occurs more than once is removed,
overlapping windows merging into maximal intervals.

A hash has 88 bits (two independent polynomials over 64-bit word hashes), so
that two different windows among 2e13 (100 TB) are expected to meet less than
once.

Defined results: a null text has no words; texts shorter than the window keep
all; repeated rows remove each other's windows (all copies go); windows are
judged on the input; an empty table gives an empty result. Only the text and
the columns in ``keep`` are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .exchange import mark_repeated
from .words import hashed_words, mixed, starts_of

_M = np.uint64
_BASE = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd, so they have inverses modulo 2**64


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, _M)
    out[:1] = 1
    return np.cumprod(out, dtype=_M)


def _rolling(x: np.ndarray, window: int, base: int) -> np.ndarray:
    """Polynomial hash modulo 2**64 of each window of x, by differences of one running sum."""
    inverse = pow(base, -1, 1 << 64)
    run = np.concatenate([np.zeros(1, _M), np.cumsum(x * _powers(inverse, len(x)), dtype=_M)])
    return mixed((run[window:] - run[:-window]) * _powers(base, len(x))[window - 1:])


def window_hashes(texts: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words per text, the first word of each window, and the two parts of its hash."""
    word, _, _, lens, _ = hashed_words(texts)
    if len(word) < window:
        none = np.zeros(0, _M)
        return lens, np.zeros(0, np.int64), none, none.astype(np.uint32)
    doc = np.repeat(np.arange(len(lens)), lens)
    start = np.flatnonzero(doc[: len(word) - window + 1] == doc[window - 1:])
    one = _rolling(word, window, _BASE[0])[start]
    two = _rolling(mixed(word + _M(1)), window, _BASE[1])[start] >> _M(40)
    return lens, start, one, two.astype(np.uint32)


def _schema(keep: T.StructType) -> T.StructType:
    spans = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    return T.StructType([*keep.fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                         T.StructField("removed", spans), T.StructField("kept_text", T.StringType())])


def _cut(rows: pa.RecordBatch, texts: list[bytes], lens: np.ndarray, gone: np.ndarray) -> pa.RecordBatch:
    """The rows (without text) with the removal intervals and the kept text."""
    at = starts_of(lens)
    n_removed, spans, kept = [], [], []
    for i, t in enumerate(texts):
        g = gone[at[i]: at[i + 1]]
        w = t.split()
        n_removed.append(int(g.sum()))
        if not n_removed[-1]:
            spans.append([])
            kept.append(b" ".join(w))
            continue
        edge = np.flatnonzero(np.diff(g.astype(np.int8), prepend=0, append=0))
        spans.append([{"start": int(a), "end": int(b)} for a, b in zip(edge[::2], edge[1::2], strict=True)])
        kept.append(b" ".join([x for x, out in zip(w, g.tolist(), strict=True) if not out]))
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    return pa.RecordBatch.from_arrays(
        [*rows.columns[1:], pa.array(lens, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(spans, span),
         pa.array(kept, pa.binary()).cast(pa.string())],
        [*rows.schema.names[1:], "n_words", "n_removed", "removed", "kept_text"],
    )


def remove_repeats(docs: DataFrame, window: int = 35, text: str = "text", **keep: Column) -> DataFrame:
    """One row per document: the columns in ``keep``, n_words, n_removed, ``removed`` (maximal intervals of
    word numbers, end exclusive) and ``kept_text`` (kept words joined by one space)."""
    src = docs.select(F.col(f"`{text}`").alias("__text"), *[c.alias(n) for n, c in keep.items()])

    def keys(texts: list[bytes]):
        lens, start, one, two = window_hashes(texts, window)
        return one, two, (lens, start)

    def finish(rows: pa.RecordBatch, texts: list[bytes], extra, again: np.ndarray) -> pa.RecordBatch:
        lens, start = extra
        edges = np.zeros(int(lens.sum()) + 1, np.int64)
        np.add.at(edges, start[again], 1)
        np.add.at(edges, start[again] + window, -1)
        return _cut(rows, texts, lens, np.cumsum(edges[:-1]) > 0)

    return mark_repeated(src, keys, finish, _schema(T.StructType(src.schema.fields[1:])))
