"""Words of a text, the same in Spark SQL and in Arrow batches.

A word is a maximal run of characters other than space, tab, line feed,
vertical tab, form feed and carriage return. ``bytes.split()`` cuts UTF-8 at
exactly these six bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of text that one step of a batch works on; a longer text is a step of its own.
STEP_BYTES = 2_000_000


def words(text: Column) -> Column:
    """Array of the words of a text column; empty for null."""
    spaced = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words as BIGINT; 0 for null."""
    return F.size(words(text)).cast("long")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow string column as UTF-8 bytes; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.large_binary()).to_pylist()]


def steps(column: pa.Array, most: int = STEP_BYTES) -> Iterator[tuple[int, int, list[bytes]]]:
    """Cut a string column into runs of rows with at most ``most`` bytes (one row at least): start, end, texts."""
    raw = column.cast(pa.large_binary())
    start = held = 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(raw), 0).to_pylist()):
        if held and held + n > most:
            yield start, i, utf8(raw.slice(start, i - start))
            start, held = i, 0
        held += n
    if start < len(raw):
        yield start, len(raw), utf8(raw.slice(start))


def tokenise(texts: list[bytes]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """All words of the texts as ids, the word of each id, and words per text."""
    split = [t.split() for t in texts]
    lens = np.fromiter(map(len, split), np.int64, len(split))
    flat = [w for s in split for w in s]
    known = {w: i for i, w in enumerate(dict.fromkeys(flat))}
    ids = np.fromiter(map(known.__getitem__, flat), np.int64, len(flat))
    return ids, list(known), lens


_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_REACH = 1 << 21
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = np.random.default_rng(20).integers(1, 1 << 63, 256).astype(np.uint64)  # a random number for each byte
_BYTE[_SPACE] = 0


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of the base and of its inverse modulo 2**64, from the 0th on."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        x = np.full(size, base, np.uint64)
        x[:1] = 1
        out.append(np.cumprod(x, dtype=np.uint64))
    return out[0], out[1]


def hashed_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]:
    """All words of the texts at once: their 64-bit hashes, where they start and end in the joined text, words per
    text, and the joined text. The hash is a polynomial over the word's bytes, taken from one running sum."""
    joined = b" ".join(texts)
    raw = np.frombuffer(joined, np.uint8)
    word = ~_SPACE[raw]
    edge = np.flatnonzero(np.diff(word.astype(np.int8), prepend=0, append=0))
    start, end = edge[::2], edge[1::2]
    value, i = np.empty(len(start), np.uint64), 0
    while i < len(start):  # as many words at a time as the powers at hand reach for, one at least
        j = max(i + 1, int(np.searchsorted(end, start[i] + _REACH, "right")))
        first, size = start[i], int(end[j - 1] - start[i])
        power, inverse = _powers(max(_REACH, size) + 1)
        run = np.zeros(size + 1, np.uint64)
        np.cumsum(_BYTE[raw[first: first + size]] * inverse[:size], out=run[1:])
        a, b = start[i:j] - first, end[i:j] - first
        value[i:j] = mixed((run[b] - run[a]) * power[a] + (b - a).astype(np.uint64))
        i = j
    text_end = np.cumsum([len(t) + 1 for t in texts])
    lens = np.diff(np.searchsorted(start, text_end), prepend=0)
    return value, start, end, lens, joined


def hashes(keys: list[bytes], seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each key."""
    one = xxhash.xxh3_64_intdigest
    return np.fromiter((one(k, seed) for k in keys), np.uint64, len(keys))


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective), so that nearby numbers spread."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def starts_of(lens: np.ndarray) -> np.ndarray:
    """First index of each run, with the total at the end."""
    return np.concatenate([[0], np.cumsum(lens)]).astype(np.int64)


def per_run(flags: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` over consecutive runs of the given lengths."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    at = starts_of(lens)
    return total[at[1:]] - total[at[:-1]]
