"""Benchmark decontamination with SimHash windows (operator 5).

The benchmark is a stated query set. It is worked off in blocks of bounded size
(``block_items`` items, collected and sent to the tasks); every block is held
against every document.

For an item of L words the windows of a document are its runs of L words. A
window can reach the similarity only if it has a shingle of the item, so
windows without one are passed over. The others get a SimHash: 128 bits, each
the sign of a sum over the window's shingles. A multi-index over the items'
fingerprints (16 blocks of 8 bits, one bit of play in each) finds all items of
that length within Hamming distance 31: of 31 differing bits, some block has at
most one. Those are verified exactly: the shingles of window and item, weighted
by how often they occur, must have a weighted Jaccard of ``pct`` percent.

Words are compared in lower case (A-Z) and without ASCII punctuation at their
ends. Shingles have ``k`` words.

Defined results: null and empty texts match nothing, as do items without words;
an item of fewer than ``k`` words matches where its whole sequence occurs; a
document shorter than an item is one window; for each document and item the
best window is given, the first one of equals; repeated rows are judged alike;
with an empty table nothing matches. ``drop_contaminated`` carries the whole row
in one struct, so names cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .words import hashes, mixed, starts_of, steps, tokenise

_M = np.uint64
BYTES = 16
RADIUS = 2 * BYTES - 1
_PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_POPCOUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)
_WINDOWS = 8192  # windows that are fingerprinted at a time


def _normal(word: bytes) -> bytes:
    return word.lower().strip(_PUNCTUATION) or word


def _word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    ids, uniq, lens = tokenise(texts)
    return hashes([_normal(w) for w in uniq])[ids], lens


def _shingles(word: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each position on."""
    out = np.zeros(max(len(word) - k + 1, 0), _M)
    for j in range(k):
        out = out * _M(0x9E3779B97F4A7C15) + word[j: j + len(out)]
    return mixed(out + _M(k))


def _signs(shingles: np.ndarray) -> np.ndarray:
    """(n, 128) of +1 and -1."""
    both = np.stack([mixed(shingles ^ _M(0x1234567)), mixed(shingles ^ _M(0x89ABCDE))], 1)
    bits = np.unpackbits(both.astype("<u8").view(np.uint8).reshape(-1, BYTES), axis=1)
    return bits.astype(np.int8) * np.int8(2) - np.int8(1)


def fingerprints(shingles: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """(n, 16) bytes: the SimHash of ``shingles[start:end]`` for each window, windows sorted by start."""
    out = []
    for a in range(0, len(start), _WINDOWS):
        s, e = start[a: a + _WINDOWS], end[a: a + _WINDOWS]
        edge = np.zeros(int(e.max() - s[0]) + 1, np.int64)
        np.add.at(edge, s - s[0], 1)
        np.add.at(edge, e - s[0], -1)
        used = np.cumsum(edge[:-1]) > 0  # positions under some window of this step
        at = np.concatenate([[0], np.cumsum(used)])
        run = np.zeros((int(at[-1]) + 1, 8 * BYTES), np.int32)
        np.cumsum(_signs(shingles[s[0]: s[0] + len(used)][used]), axis=0, dtype=np.int32, out=run[1:])
        out.append(np.packbits(run[at[e - s[0]]] > run[at[s - s[0]]], axis=1))
    return np.concatenate(out) if out else np.zeros((0, BYTES), np.uint8)


@dataclass
class _Group:
    """The items of one length, with the multi-index over their fingerprints."""

    items: np.ndarray
    prints: np.ndarray
    near: np.ndarray  # (16, 256, items): whether an item's block is within one bit of a value


@dataclass
class Index:
    """A block of the benchmark."""

    k: int
    ids: list
    lengths: np.ndarray
    shingles: list[np.ndarray]
    groups: dict[int, _Group]
    anchors: np.ndarray  # sorted shingles of all items
    owners: np.ndarray  # the item of each anchor
    short: list[tuple[int, int, int]]  # item, words, hash of the whole sequence


def build_index(items: list[tuple[object, str | None]], k: int) -> Index:
    texts = [(t or "").encode() for _, t in items]
    word, lens = _word_hashes(texts)
    at = starts_of(lens)
    shingles, short, by_length = [], [], {}
    for i, n in enumerate(lens.tolist()):
        shingles.append(_shingles(word[at[i]: at[i + 1]], k))
        if n >= k:
            by_length.setdefault(n, []).append(i)
        elif n:
            short.append((i, n, int(_shingles(word[at[i]: at[i + 1]], n)[0])))
    value = np.arange(256)
    close = _POPCOUNT[value[:, None] ^ value[None, :]] <= 1
    groups = {}
    for n, own in by_length.items():
        prints = np.concatenate([fingerprints(shingles[i], np.array([0]), np.array([len(shingles[i])])) for i in own])
        groups[n] = _Group(np.array(own), prints, np.stack([close[:, prints[:, b]] for b in range(BYTES)]))
    pairs = np.concatenate([np.zeros(0, _M), *shingles])
    owner = np.repeat(np.arange(len(items)), [len(s) for s in shingles])
    order = np.argsort(pairs, kind="stable")
    return Index(k, [i for i, _ in items], lens, shingles, groups, pairs[order], owner[order], short)


def weighted_jaccard(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Sum of the smaller and of the larger counts over the values of two multisets."""
    _, which = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = np.bincount(which[: len(a)], minlength=which.max() + 1), np.bincount(which[len(a):], minlength=which.max() + 1)
    return int(np.minimum(x, y).sum()), int(np.maximum(x, y).sum())


def search(texts: list[bytes], index: Index, pct: int) -> list[tuple[int, int, float, int, int]]:
    """(text, item, similarity, first word, words) of the best window of each pair that matches."""
    word, lens = _word_hashes(texts)
    k, at = index.k, starts_of(lens)
    doc = np.repeat(np.arange(len(lens)), lens)
    best: dict[tuple[int, int], tuple] = {}

    def note(d: int, i: int, common: int, whole: int, first: int, n: int) -> None:
        found = (common / whole, -first, n)
        if (d, i) not in best or found > best[d, i]:
            best[d, i] = found

    for i, n, key in index.short:
        whole = _shingles(word, n)
        for p in np.flatnonzero((whole == _M(key)) & (doc[: len(whole)] == doc[n - 1:])).tolist():
            note(int(doc[p]), i, 1, 1, p - int(at[doc[p]]), n)
    shingle = _shingles(word, k)
    if len(shingle) and len(index.anchors):
        inside = doc[: len(shingle)] == doc[k - 1:]
        lo, hi = np.searchsorted(index.anchors, shingle, "left"), 0
        hit = np.flatnonzero(inside & (index.anchors[np.minimum(lo, len(index.anchors) - 1)] == shingle))
        lo, hi = lo[hit], np.searchsorted(index.anchors, shingle[hit], "right")
        times = hi - lo
        place = np.repeat(hit, times)
        owner = index.owners[np.arange(int(times.sum())) + np.repeat(lo - starts_of(times)[:-1], times)]
        length = index.lengths[owner]
        for n, group in index.groups.items():
            p = place[length == n]
            if not len(p):
                continue
            begin, stop = at[doc[p]], at[doc[p] + 1]
            first, last = np.maximum(p - (n - k), begin), np.maximum(np.minimum(p, stop - n), begin)
            edge = np.zeros(len(word) + 1, np.int64)
            np.add.at(edge, first, 1)
            np.add.at(edge, last + 1, -1)
            start = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
            words = np.minimum(n, at[doc[start] + 1] - start)
            prints = fingerprints(shingle, start, start + words - k + 1)
            for a in range(0, len(start), _WINDOWS):
                part = prints[a: a + _WINDOWS]
                may = np.zeros((len(part), len(group.items)), bool)
                for b in range(BYTES):
                    may |= group.near[b, part[:, b]]
                w, i = np.nonzero(may)
                close = _POPCOUNT[part[w] ^ group.prints[i]].sum(1, dtype=np.int64) <= RADIUS
                for x, y in zip((w[close] + a).tolist(), group.items[i[close]].tolist(), strict=True):
                    s, m = int(start[x]), int(words[x])
                    common, whole = weighted_jaccard(shingle[s: s + m - k + 1], index.shingles[y])
                    if common * 100 >= whole * pct:
                        note(int(doc[s]), y, common, whole, s - int(at[doc[s]]), m)
    return [(d, i, x[0], -x[1], x[2]) for (d, i), x in sorted(best.items())]


def blocks(benchmark: DataFrame, k: int, block_items: int, item_id: str = "item_id", text: str = "text") -> Iterator[Index]:
    """The benchmark in blocks of about ``block_items`` items, dealt by a hash of the text."""
    n = max(1, -(-benchmark.count() // block_items))
    items = benchmark.select(F.col(f"`{item_id}`").cast("long").alias("item_id"), F.col(f"`{text}`").alias("text"))
    for b in range(n):
        own = items.where(F.pmod(F.xxhash64(*items.columns), F.lit(n)) == b).orderBy(*items.columns).collect()
        yield build_index([(r[0], r[1]) for r in own], k)


def _over(docs: DataFrame, text: str, keep: dict[str, Column], schema: T.StructType,
          work: Callable[[pa.RecordBatch, list[bytes]], pa.RecordBatch]) -> DataFrame:
    src = docs.select(F.col(f"`{text}`").alias("__text"), *[c.alias(n) for n, c in keep.items()])

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in stream:
            for a, b, texts in steps(rows.column(0)):
                yield work(rows.slice(a, b - a), texts)

    return src.mapInArrow(run, schema)


def find_matches(docs: DataFrame, benchmark: DataFrame, k: int = 5, pct: int = 80, block_items: int = 2000,
                 doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document and item that match: doc_id, item_id, similarity, first_word, n_words."""
    schema = T.StructType([
        docs.select(F.col(f"`{doc_id}`").alias("doc_id")).schema[0], T.StructField("item_id", T.LongType()),
        T.StructField("similarity", T.DoubleType()), T.StructField("first_word", T.LongType()), T.StructField("n_words", T.LongType()),
    ])
    out = None
    for index in blocks(benchmark, k, block_items):
        def work(rows: pa.RecordBatch, texts: list[bytes], index: Index = index) -> pa.RecordBatch:
            found = search(texts, index, pct)
            cols = list(zip(*found, strict=True)) or [()] * 5
            return pa.RecordBatch.from_arrays([
                rows.column(1).take(pa.array(cols[0], pa.int64())),
                pa.array([index.ids[i] for i in cols[1]], pa.int64()),
                pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64()),
            ], ["doc_id", "item_id", "similarity", "first_word", "n_words"])

        got = _over(docs, text, {"doc_id": F.col(f"`{doc_id}`")}, schema, work)
        out = got if out is None else out.unionAll(got)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, k: int = 5, pct: int = 80, block_items: int = 2000,
                      text: str = "text") -> DataFrame:
    """The documents that match no item, with all their columns."""
    out = docs
    for index in blocks(benchmark, k, block_items):
        def work(rows: pa.RecordBatch, texts: list[bytes], index: Index = index) -> pa.RecordBatch:
            clean = np.ones(len(texts), bool)
            clean[[d for d, *_ in search(texts, index, pct)]] = False
            return rows.select(["row"]).filter(pa.array(clean))

        row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
        schema = T.StructType([T.StructField("row", docs.schema)])
        out = _over(out, text, {"row": row}, schema, work).select("row.*")
    return out
