"""Periodic runs of words within documents (operator 13).

A run is a stretch of consecutive words with smallest period q and at least
``max(least, 3 * q)`` words that no neighbouring word extends. At each dyadic
scale the words are cut into blocks of B. A run with a period from B to 2B - 1
(from 1 on at the smallest scale, where B = ``least`` / 3 and runs are at least
3 * B long) holds a whole block and the block's copy one period further on. So
each block is slid over the window behind it: the sum of squared differences of
word numbers is 0 exactly where the block occurs again. The sums come from one
number-theoretic transform per block and window (integers modulo 998244353, no
rounding); a sum that is 0 modulo the prime only is found out when the words
are compared. Blocks with a word that does not occur again within the window
cannot occur again either and are not transformed.

A distance at which a block occurs again seeds a period: the stretch around the
block is extended while words at that distance agree. Scales and distances go
up, so smallest periods come first, and a distance that is a multiple of a
known run's period, inside that run, says nothing new.

Documents of a batch are worked on together; the work on a text of n words grows
like n log^2 n, its memory like n.

Defined results: a null or empty text has no words and no runs; repeated rows
are each reported; an empty table gives an empty result. Words are compared as
they are, byte by byte. Only the text and the columns in ``keep`` are read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .words import starts_of, steps

LEAST = 24
PRIME = 998244353  # 119 * 2**23 + 1
_ROOT = 3
_LONGEST = 1 << 23  # of a transform modulo the prime
_CELLS = 1 << 19  # numbers that one transform works on at a time
_P = np.uint64(PRIME)

#: rewrite(row number, words) gives the words to look at.
Rewrite = Callable[[int, list[bytes]], list[bytes]]


@lru_cache(maxsize=64)
def _twiddles(size: int, inverse: bool) -> np.ndarray:
    """The first half of the powers of a root of unity of order ``size``."""
    root = pow(_ROOT, (PRIME - 1) // size, PRIME)
    root = pow(root, -1, PRIME) if inverse else root
    out, n = np.ones(max(size // 2, 1), np.uint64), 1
    while n < len(out):
        out[n: 2 * n] = out[:n] * np.uint64(pow(root, n, PRIME)) % _P
        n *= 2
    return out


def transform(x: np.ndarray, inverse: bool = False) -> np.ndarray:
    """Number-theoretic transform of each row (the length is a power of two, numbers below the prime).

    Forwards it leaves the values in bit-reversed order, backwards it takes them so, undivided: products need no order.
    """
    rows, size = x.shape
    x = x.astype(np.uint64)
    half = 1 if inverse else size // 2
    while 1 <= half < size:
        pair = x.reshape(rows, size // (2 * half), 2, half)
        a, b, w = pair[:, :, 0], pair[:, :, 1], _twiddles(2 * half, inverse)
        if inverse:
            b = b * w % _P
            pair[:, :, 0], pair[:, :, 1] = (a + b) % _P, (a + (_P - b)) % _P
        else:
            pair[:, :, 0], pair[:, :, 1] = (a + b) % _P, (a + (_P - b)) * w % _P
        half = half * 2 if inverse else half // 2
    return x


def zero_distances(word: np.ndarray, begin: np.ndarray, block: int, near: int, far: int) -> tuple[np.ndarray, np.ndarray]:
    """(index into ``begin``, distance) where the sum of squared differences of a block and the words ``distance``
    on is 0 modulo the prime; distances from ``near`` to ``far`` - 1; ``word`` reaches beyond the last window."""
    window = far - near + block - 1
    size = 1 << (window - 1).bit_length()
    if size > _LONGEST:
        return _halved(word, begin, block, near, far)
    scale = np.uint64(pow(size, -1, PRIME))
    blocks, distances = [], []
    step = max(1, _CELLS // size)
    for i in range(0, len(begin), step):
        at = begin[i: i + step, None]
        x, y = word[at + np.arange(block)], word[at + near + np.arange(window)]
        one, two = np.zeros((len(at), size), np.uint64), np.zeros((len(at), size), np.uint64)
        one[:, :block] = x[:, ::-1]
        two[:, :window] = y
        both = transform(transform(one) * transform(two) % _P, True)[:, block - 1: window] * scale % _P
        run = np.zeros((len(at), window + 1), np.uint64)
        np.cumsum(y * y % _P, axis=1, out=run[:, 1:])
        squares = run[:, block:] - run[:, :-block] + (x * x % _P).sum(axis=1, dtype=np.uint64)[:, None]
        row, d = np.nonzero((squares + np.uint64(2) * (_P - both)) % _P == 0)
        blocks.append(row + i)
        distances.append(d + near)
    return (np.concatenate(blocks), np.concatenate(distances)) if blocks else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _halved(word: np.ndarray, begin: np.ndarray, block: int, near: int, far: int) -> tuple[np.ndarray, np.ndarray]:
    """The same where both halves of a block occur again, from transforms half as long."""
    half, middle, found = block // 2, (near + far) // 2, []
    for lo, hi in ((near, middle), (middle, far)):
        one, two = (zero_distances(word, at, half, lo, hi) for at in (begin, begin + half))
        found.append(np.intersect1d(one[0] * far + one[1], two[0] * far + two[1], assume_unique=True))
    both = np.concatenate(found)
    return both // far, both % far


def _reach(word: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """How far on the same word occurs again in the same document (very far: never)."""
    order = np.lexsort((word, doc))
    same = (word[order[1:]] == word[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
    out = np.full(len(word), 1 << 40)
    out[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return out


def _agree(a: np.ndarray, b: np.ndarray) -> int:
    """How many of the first items agree, looked at in growing pieces."""
    n, i, size = min(len(a), len(b)), 0, 64
    while i < n:
        j = min(n, i + size)
        differ = np.flatnonzero(a[i:j] != b[i:j])
        if len(differ):
            return i + int(differ[0])
        i, size = j, size * 4
    return n


def find_in(word: np.ndarray, lens: np.ndarray, least: int = LEAST) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each of several documents, whose word numbers follow one another."""
    at = starts_of(lens)
    doc = np.repeat(np.arange(len(lens)), lens)
    found: list[list[tuple[int, int, int]]] = [[] for _ in lens]
    if not len(word) or int(lens.max()) < least:
        return found
    reach = _reach(word, doc)
    block = 1 << (max(least // 3, 1).bit_length() - 1)
    near, highest = 1, reach[: len(word) // block * block].reshape(-1, block).max(axis=1)
    number = np.zeros(len(word) + 4 * int(lens.max()) + 4 * block, np.uint64)
    number[: len(word)] = word + 1
    while 3 * max(near, 1) <= int(lens.max()):
        far = 2 * block
        begin = np.flatnonzero(highest < far) * block
        begin = begin[at[doc[begin] + 1] - begin >= block + near]
        which, distance = zero_distances(number, begin, block, near, far)
        if len(which):
            _extend(word, at, doc, begin[which], distance, block, least, found)
        highest = highest[: len(highest) // 2 * 2].reshape(-1, 2).max(axis=1)
        near, block = far, far
    return [sorted(x, key=lambda r: (r[0], r[2])) for x in found]


def _extend(word: np.ndarray, at: np.ndarray, doc: np.ndarray, begin: np.ndarray, distance: np.ndarray, block: int, least: int, found: list) -> None:
    """Add the runs that the seeds (block at ``begin``, again ``distance`` on) belong to, document by document."""
    owner = doc[begin]
    fits = begin + distance + block <= at[owner + 1]
    begin, distance, owner = begin[fits], distance[fits], owner[fits]
    order = np.lexsort((begin, distance, owner))
    begin, distance, owner = begin[order], distance[order], owner[order]
    cuts = np.flatnonzero((np.diff(owner) != 0) | (np.diff(distance) != 0)) + 1
    known: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # by period: where the document's runs start and end
    before = -1
    for i, b in zip([0, *cuts.tolist()] if len(begin) else [], np.split(begin, cuts), strict=False):
        k, q = int(owner[i]), int(distance[i])
        lo, hi = int(at[k]), int(at[k + 1])
        if k != before:
            known, before = _by_period(found[k]), k
        for period in [p for p in known if q % p == 0]:
            start, end = known[period]
            last = np.searchsorted(start, b - lo, "right") - 1
            b = b[(last < 0) | (end[last] < b - lo + q + block)]
        new, n = [], 0
        while n < len(b):
            x = int(b[n])
            right = _agree(word[x: hi - q], word[x + q: hi])
            n += 1
            if right >= block:  # else a sum that is 0 modulo the prime only
                left = _agree(word[lo:x][::-1], word[lo + q: x + q][::-1])
                start, length = x - left - lo, left + right + q
                n = max(n, int(np.searchsorted(b, lo + start + length - q - block, "right")))
                if length >= max(least, 3 * q):
                    new.append((start, length, q))
        if new:
            found[k].extend(new)
            known |= _by_period(new)


def _by_period(runs: list[tuple[int, int, int]]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Start and end of the runs of each period, in order."""
    held: dict[int, list[tuple[int, int]]] = {}
    for start, length, period in runs:
        held.setdefault(period, []).append((start, start + length))
    return {p: tuple(np.array(sorted(x)).T) for p, x in held.items()}


def _schema(keep: list[T.StructField]) -> T.StructType:
    run = T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")])
    return T.StructType([*keep, T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(run)),
                         T.StructField("best", run), T.StructField("collapsed", T.StringType())])


def find_runs(docs: DataFrame, text: str = "text", least: int = LEAST, rewrite: Callable[[dict], Rewrite] | None = None, **keep: Column) -> DataFrame:
    """One row per document: the columns in ``keep``, n_words, ``runs`` (start, length, period; by start, then period),
    ``best`` (the greatest length / period, then the smallest start and period; null without runs) and ``collapsed`` (the
    words that no run holds after its first period, joined by one space).

    ``rewrite`` may change the words before: it gets the kept columns of a batch and gives a function of row and words.
    """
    src = docs.select(F.col(f"`{text}`").alias("__text"), *[c.alias(n) for n, c in keep.items()])
    schema = _schema(src.schema.fields[1:])
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def work(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in stream:
            for a, b, texts in steps(rows.column(0)):
                part = rows.slice(a, b - a)
                words = [t.split() for t in texts]
                if rewrite is not None:
                    change = rewrite({n: part.column(n).to_pylist() for n in part.schema.names[1:]})
                    words = [change(i, w) for i, w in enumerate(words)]
                lens = np.fromiter(map(len, words), np.int64, len(words))
                known: dict[bytes, int] = {}
                number = np.fromiter((known.setdefault(x, len(known)) for w in words for x in w), np.int64, int(lens.sum()))
                runs = find_in(number, lens, least)
                best, left = [], []
                for w, own in zip(words, runs, strict=True):
                    top = max(own, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
                    best.append(top and dict(zip(("start", "length", "period"), top, strict=True)))
                    left.append(b" ".join(_collapsed(w, own)))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array(lens, pa.int64()),
                     pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in own] for own in runs], pa.list_(run)),
                     pa.array(best, run), pa.array(left, pa.binary()).cast(pa.string())], schema.names)

    return src.mapInArrow(work, schema)


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words that stay."""
    if not runs:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return [w for w, n in zip(words, np.cumsum(edge[:-1]).tolist(), strict=True) if not n]
