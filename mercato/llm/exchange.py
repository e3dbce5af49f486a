"""Which keys of a batch of documents occur elsewhere in the corpus.

Keys are 88-bit hashes (64 and 24 bits) that documents make many of, such as
one per word. Documents are worked on in batches (a few megabytes of text). A
batch sends each distinct key once, in packed sorted blocks, one per range of
key values; the task that owns a range marks the keys that other batches sent
as well and answers with one bit per key. The batch's rows, kept compressed,
meet the answers again. A key that a third of all documents have is sent once
per batch, and no key travels as a row of its own.

The input has to give the same rows in the same order whenever a partition is
read again, as files do. A batch is named by its content as well, so that a
table that changes in between ends in an error and not in a wrong result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .words import starts_of, steps, utf8

_M = np.uint64

#: keys(texts) gives the two parts of each key and whatever ``finish`` needs with them.
Keys = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray, Any]]
#: finish(rows, texts, extra, again) makes the output; ``again`` says for each key whether it occurs a second time.
Finish = Callable[[pa.RecordBatch, list[bytes], Any, np.ndarray], pa.RecordBatch]


def _distinct(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, each one's count, and where each input is among them."""
    order = np.argsort(one, kind="stable")
    a, b = one[order], two[order]
    if np.any((a[1:] == a[:-1]) & (b[1:] != b[:-1])):
        order = np.lexsort((two, one))
        a, b = one[order], two[order]
    first = np.ones(len(a), bool)
    first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    at = np.cumsum(first) - 1
    where = np.empty(len(a), np.int64)
    where[order] = at
    return a[first], b[first], np.bincount(at, minlength=int(first.sum())), where


def _ranges(one: np.ndarray, n: int) -> np.ndarray:
    """Where each of n equal ranges of key values begins among the sorted keys, with the end."""
    owner = ((one >> _M(32)) * _M(n)) >> _M(32)
    return np.searchsorted(owner, np.arange(n + 1, dtype=_M))


def _pack(one: np.ndarray, two: np.ndarray) -> bytes:
    """Gaps between sorted keys and the second parts, byte plane by byte plane."""
    gaps = np.diff(one, prepend=_M(0))
    planes = gaps.astype("<u8").view(np.uint8).reshape(-1, 8).T
    check = two.astype("<u4").view(np.uint8).reshape(-1, 4).T[:3]
    return zstandard.compress(planes.tobytes() + check.tobytes(), 1)


def _unpack(body: bytes) -> tuple[np.ndarray, np.ndarray]:
    flat = np.frombuffer(zstandard.decompress(body), np.uint8).reshape(11, -1)
    one = np.cumsum(np.ascontiguousarray(flat[:8].T).view("<u8").ravel(), dtype=_M)
    two = np.zeros((flat.shape[1], 4), np.uint8)
    two[:, :3] = flat[8:].T
    return one, two.view("<u4").ravel()


def batches(stream: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.RecordBatch, list[bytes]]]:
    """Name, rows and texts (the first column) of each batch of a partition."""
    part, n = TaskContext.get().partitionId(), 0
    for rows in stream:
        for a, b, texts in steps(rows.column(0)):
            seen = xxhash.xxh3_128()
            for t in texts:
                seen.update(b"%d:" % len(t))
                seen.update(t)
            yield f"{part}:{n}:{seen.hexdigest()}", rows.slice(a, b - a), texts
            n += 1


def held_batches(src: DataFrame) -> DataFrame:
    """(batch, body): the rows of every batch, compressed."""

    def hold(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))
        for name, rows, _ in batches(stream):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, rows.schema, options=options) as writer:
                writer.write_batch(rows)
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["batch", "body"])

    return src.mapInArrow(hold, "batch string, body binary")


def opened(held: pa.Table, answered: pa.Table) -> tuple[pa.RecordBatch, list[bytes], ValueError]:
    """Rows and texts of a held batch, and the error to raise if its answers are not complete."""
    name = (held if held.num_rows else answered)["batch"][0].as_py()
    changed = ValueError(f"batch {name} was read differently the second time: the input changed")
    if held.num_rows != 1:
        raise changed
    rows = pa.ipc.open_stream(held["body"][0].as_py()).read_all().combine_chunks().to_batches()[0]
    return rows, utf8(rows.column(0)), changed


def mark_repeated(src: DataFrame, keys: Keys, finish: Finish, schema: T.StructType) -> DataFrame:
    """``finish`` of every batch of ``src`` (its first column is the text), with the keys that occur elsewhere."""
    n = int(src.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = ["batch", "owner", "body"]

    def send(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, _, texts in batches(stream):
            one, two, _ = keys(texts)
            one, two, _, _ = _distinct(one, two)
            at = _ranges(one, n)
            full = [k for k in range(n) if at[k] < at[k + 1]]
            bodies = [_pack(one[at[k]: at[k + 1]], two[at[k]: at[k + 1]]) for k in full]
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(full), pa.string()), pa.array(full, pa.int32()), pa.array(bodies, pa.binary())], names)

    def count(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        who, owners, ones, twos = [], [], [], []
        for rows in stream:
            for name, owner, body in zip(*[c.to_pylist() for c in rows.columns], strict=True):
                one, two = _unpack(body)
                who.append(name)
                owners.append(owner)
                ones.append(one)
                twos.append(two)
        if not who:
            return
        _, _, times, where = _distinct(np.concatenate(ones), np.concatenate(twos))
        again, at = (times > 1)[where], starts_of(np.array([len(x) for x in ones]))
        bodies = [np.packbits(again[at[i]: at[i + 1]]).tobytes() for i in range(len(who))]
        yield pa.RecordBatch.from_arrays([pa.array(who, pa.string()), pa.array(owners, pa.int32()), pa.array(bodies, pa.binary())], names)

    def meet(held: pa.Table, answered: pa.Table) -> pa.Table:
        rows, texts, changed = opened(held, answered)
        bodies = dict(zip(answered["owner"].to_pylist(), answered["body"].to_pylist(), strict=True))
        one, two, extra = keys(texts)
        one, _, times, where = _distinct(one, two)
        at, again = _ranges(one, n), times > 1
        for k in range(n):
            if at[k] < at[k + 1]:
                if k not in bodies:
                    raise changed
                bits = np.unpackbits(np.frombuffer(bodies[k], np.uint8), count=int(at[k + 1] - at[k]))
                again[at[k]: at[k + 1]] |= bits.astype(bool)
        return pa.Table.from_batches([finish(rows, texts, extra, again[where])])

    answers = src.mapInArrow(send, "batch string, owner int, body binary")
    answers = answers.repartitionById(n, "owner").mapInArrow(count, "batch string, owner int, body binary")
    return held_batches(src).groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(meet, schema)
