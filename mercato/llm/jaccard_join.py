"""Jaccard self-join of documents on word shingles by T-occurrence search (operator 9).

A document's set is that of its distinct shingles of ``k`` words (lower-cased
A-Z). Equal sets form one class, which takes part once. A set of n shingles
shares at least ``ceil(pct * n / 100)`` of them with any set it is linked to, so
one with fewer shingles that occur elsewhere (see exchange.py) is linked to no
other and goes no further; neither do shingles that occur once.

The sets left are ordered by the frequency of their shingles, rare ones first.
Two linked sets have a shingle in common among the first ``n - need + 1`` of each,
where ``need`` is the least overlap above; shingles that occur once count as
first, so few or none are left. The smaller of two linked sets also shares
``2 * pct / (100 + pct)`` of its shingles or more (a "rich" set), so a common
shingle counts only if one of its sets is rich. What such shingles connect
is a candidate group.

Within a candidate group (in blocks of ``block`` classes) a T-occurrence search
over the group's inverted lists finds the links: of the lists of a set's
shingles the longest are set aside, the short ones are merged with a heap, and
classes that reach the remaining threshold are looked up in the long lists by
binary search (DivideSkip). Pairs already connected are not searched again. A group of more
than one block is first searched block by block, each with the group's first
rich class; only if that leaves it unconnected are its blocks paired, each block of rich
classes with every other, so a large group of copies around one original costs a
linear pass, and no link is lost in any case.

Shingle hashes have 64 bits, as have class ids; candidates are verified on the
shingle hashes.

Defined results: null and empty texts have an empty set and link with nothing
(their component is their own id); a text with fewer than ``k`` words has its
whole sequence as one shingle; rows with equal ids and different texts are
documents of their own that share the label; a null id counts as larger than
any other, and a component of null ids only is null; an empty table gives an
empty result. Only id, text and the columns in ``keep`` are read.
"""

from __future__ import annotations

import heapq
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .components import components
from .exchange import mark_repeated
from .tables import settled
from .words import hashed_words, mixed, starts_of

_M = np.uint64
_NO_ID = (1 << 63) - 1


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    word, _, _, lens, _ = hashed_words([t.lower() for t in texts])
    at, out = starts_of(lens), []
    whole = np.zeros(max(len(word) - k + 1, 0), _M)
    for j in range(k):
        whole = whole * _M(0x9E3779B97F4A7C15) + word[j: j + len(whole)]
    whole = mixed(whole)
    for i, n in enumerate(lens.tolist()):
        if n >= k:
            out.append(np.unique(whole[at[i]: at[i] + n - k + 1]))
        elif n:
            out.append(np.array([xxhash.xxh3_64_intdigest(word[at[i]: at[i + 1]].tobytes(), n)], _M))
        else:
            out.append(np.zeros(0, _M))
    return out


def least_overlap(n: int, pct: int) -> int:
    """How many shingles a set of n has in common with any set it is linked to, at least."""
    return -(-pct * n // 100)


def _sets(docs: DataFrame, k: int, pct: int, doc_id: str, text: str, keep: dict[str, Column]) -> DataFrame:
    """doc_id, the kept columns, n, class (null if empty), and the shingles that occur elsewhere, if there are
    enough of them for a link (else none)."""
    src = docs.select(F.col(f"`{text}`").alias("text"), F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                      *[c.alias(n) for n, c in keep.items()])

    def keys(texts: list[bytes]):
        sets = shingle_sets(texts, k)
        one = np.concatenate(sets) if sets else np.zeros(0, _M)
        return one, np.zeros(len(one), np.uint32), sets

    def finish(rows: pa.RecordBatch, texts: list[bytes], sets: list[np.ndarray], again: np.ndarray) -> pa.RecordBatch:
        at = starts_of(np.array([len(s) for s in sets], np.int64))
        shared = [s[again[at[i]: at[i + 1]]].view(np.int64) for i, s in enumerate(sets)]
        shared = [x if len(x) >= least_overlap(len(s), pct) else x[:0] for s, x in zip(sets, shared, strict=True)]
        ident = [xxhash.xxh3_64_intdigest(s.tobytes(), 7) - (1 << 63) if len(s) else None for s in sets]
        return pa.RecordBatch.from_arrays(
            [*rows.columns[1:], pa.array([len(s) for s in sets], pa.int64()), pa.array(ident, pa.int64()),
             pa.array(shared, pa.list_(pa.int64()))],
            [*rows.schema.names[1:], "n", "class", "shingles"],
        )

    made = [("n", T.LongType()), ("class", T.LongType()), ("shingles", T.ArrayType(T.LongType()))]
    return mark_repeated(src, keys, finish, T.StructType([*src.schema.fields[1:], *[T.StructField(*x) for x in made]]))


def ranked_sets(members: DataFrame, frequent: DataFrame, pct: int) -> DataFrame:
    """class, n, rich, shingles and prefix of the classes that may have links. ``members`` has class, n and
    shingles; ``frequent`` has ``__shingle`` and ``df``, the number of classes, of every shingle of two or more."""
    spots = members.select("class", "n", F.explode("shingles").alias("shingle"))
    held = spots.join(frequent, F.col("shingle") == F.col("__shingle")).groupBy("class", "n").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("df", "shingle"))), lambda x: x["shingle"]).alias("shingles"))
    need, shared = F.expr(f"int((n * {pct} + 99) div 100)"), F.size("shingles")
    return held.where(shared >= need).select(
        "class", "n", (shared * (100 + pct) >= F.col("n") * (2 * pct)).alias("rich"), "shingles",
        F.slice("shingles", F.lit(1), shared - need + 1).alias("prefix"))


def t_occurrence(sets: list[np.ndarray], labels: list[int], pct: int, sizes: np.ndarray | None = None,
                 rich: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links (i, j) that connect all linked sets; sets with one label count as connected already.

    ``sizes`` are those of the sets with the shingles that were left out as they occur nowhere else; a set that is
    not ``rich`` is linked to smaller ones only.
    """
    c = len(sets)
    root = {}
    top = []
    for i, x in enumerate(labels):
        top.append(root.setdefault(x, i))

    def find(i: int) -> int:
        while top[i] != i:
            top[i] = top[top[i]]
            i = top[i]
        return i

    held_size = np.array([len(s) for s in sets])
    size = held_size if sizes is None else sizes
    rich = np.ones(c, bool) if rich is None else rich
    owner = np.repeat(np.arange(c), held_size)
    _, token = np.unique(np.concatenate(sets), return_inverse=True)
    at = starts_of(held_size)
    lists = np.sort(token * c + owner)  # the inverted lists one after another, each sorted by set
    held = lists % c
    length = np.bincount(token)
    begin = starts_of(length)
    links = []
    order = np.argsort(size, kind="stable")
    rank = np.empty(c, np.int64)
    rank[order] = np.arange(c)
    for q in order.tolist():
        n = int(size[q])
        need = least_overlap(n, pct)
        mine = token[at[q]: at[q + 1]]
        mine = mine[length[mine] > 1]
        if len(mine) < need:
            continue
        mine = mine[np.argsort(length[mine], kind="stable")]
        aside = min(int(need / (0.0085 * np.log2(float(length[mine[-1]])) + 1)), need - 1)
        short, long = mine[: len(mine) - aside], mine[len(mine) - aside:]
        fits = (rank < rank[q]) & (size * 100 >= n * pct) & rich
        for y, run in groupby(heapq.merge(*[held[begin[t]: begin[t + 1]].tolist() for t in short.tolist()])):
            count = sum(1 for _ in run)
            if count < need - aside or not fits[y]:
                continue
            a, b = find(q), find(y)
            if a == b:
                continue
            probe = long * c + y
            spot = np.minimum(np.searchsorted(lists, probe), len(lists) - 1)
            common = count + int((lists[spot] == probe).sum())
            if common * 100 >= pct * (n + int(size[y]) - common):
                links.append((q, y))
                top[a] = b
    return links


def _search(members: DataFrame, pct: int) -> DataFrame:
    """Links (a, b) found within each (comp, i, j) of ``members``."""

    def search(group: pa.Table) -> pa.Table:
        node = group["class"].to_pylist()
        column = group["shingles"].combine_chunks()
        at = column.offsets.to_numpy()
        flat = column.values.to_numpy().view(_M)
        sets = [flat[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
        found = t_occurrence(sets, group["label"].to_pylist(), pct, group["n"].to_numpy(), group["rich"].to_numpy())
        return pa.table({"a": pa.array([node[i] for i, _ in found], pa.int64()), "b": pa.array([node[j] for _, j in found], pa.int64())})

    return members.groupBy("comp", "i", "j").applyInArrow(search, "a long, b long")


def near_duplicates(docs: DataFrame, k: int = 3, pct: int = 90, block: int = 128, doc_id: str = "doc_id",
                    text: str = "text", **keep: Column) -> DataFrame:
    """One row per document: doc_id, the columns in ``keep``, n_shingles, class_id and group_id (the component's
    smallest class; both null for an empty set) and component_id (the component's smallest document)."""
    spark = docs.sparkSession

    def written(df: DataFrame, name: str) -> DataFrame:
        return settled(df, f"jaccard_{name}")

    def written_raw(df: DataFrame, name: str) -> DataFrame:
        """Hashes do not compress; without trying, the writers need less memory."""
        path = scratch_path(spark, f"jaccard_{name}")
        df.write.option("compression", "uncompressed").option("parquet.enable.dictionary", "false").parquet(path)
        return spark.read.parquet(path)

    sets = written_raw(_sets(docs, k, pct, doc_id, text, keep), "sets")
    members = sets.where("size(shingles) > 0").groupBy("class").agg(F.first("n").alias("n"), F.first("shingles").alias("shingles"))
    members = written_raw(members, "members")
    frequent = members.select(F.explode("shingles").alias("__shingle")).groupBy("__shingle").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    members = written_raw(ranked_sets(members, frequent, pct), "ranked")

    spots = members.select("class", "rich", F.explode("prefix").alias("shingle"))
    shared = spots.groupBy("shingle").agg(F.min(F.when(F.col("rich"), F.col("class"))).alias("lead"), F.min("class").alias("low"),
                                          F.max("class").alias("last")).where("lead is not null and low <> last")
    shared = written(shared.select(F.col("shingle").alias("__shingle"), "lead"), "shared")
    pairs = spots.join(shared, F.col("shingle") == F.col("__shingle")).where("class <> lead")
    groups = components(pairs.select(F.col("class").alias("a"), F.col("lead").alias("b")))
    kinds = members.select("class", "rich")
    groups = written(groups.join(kinds, F.col("node") == F.col("class")).select("node", "label", "rich"), "groups")

    def blocks_of(kind: Column) -> Column:
        return F.ceil(F.count_if(kind) / block).cast("int")

    blocks = groups.groupBy("label").agg(F.min(F.when(F.col("rich"), F.col("node"))).alias("lead"), blocks_of(F.col("rich")).alias("rich_blocks"),
                                         blocks_of(~F.col("rich")).alias("poor_blocks"))
    blocks = written(blocks.withColumnRenamed("label", "__label"), "blocks")
    placed = groups.join(blocks, F.col("label") == F.col("__label")).select(
        "node", F.col("label").alias("comp"), "lead", "rich_blocks", (F.col("rich_blocks") + F.col("poor_blocks")).alias("blocks"))
    candidates = members.select("class", "n", "rich", "shingles").join(written(placed, "placed"), F.col("class") == F.col("node")).drop("node")
    members = written_raw(candidates, "placed_sets")

    spot = F.xxhash64("class")
    own = F.when(F.col("rich"), F.pmod(spot, F.col("rich_blocks"))).otherwise(
        F.col("rich_blocks") + F.pmod(spot, F.col("blocks") - F.col("rich_blocks"))).cast("int")
    spread = F.when(F.col("class") == F.col("lead"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(own))
    first = members.withColumn("i", F.explode(spread)).withColumns({"j": F.col("i"), "label": F.col("class")})
    searched = ["class", "n", "rich", "shingles", "comp", "label", "i", "j"]
    links = written(_search(first.select(searched), pct), "links")
    labels = written(components(links).withColumnRenamed("label", "found"), "labels")

    large = members.where("blocks > 1").join(labels, F.col("class") == F.col("node"), "left").drop("node")
    large = written_raw(large.withColumn("label", F.coalesce("found", "class")).drop("found"), "large")
    open_ = large.groupBy("comp").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
    open_ = written(open_.select(F.col("comp").alias("__comp")), "open")
    partners = F.when(F.col("rich"), F.col("blocks")).otherwise(F.col("rich_blocks"))
    rest = large.join(open_, F.col("comp") == F.col("__comp"), "left_semi").withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), partners - 1))
    ).withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})
    more = _search(rest.where("i < j").select(searched), pct)
    links = links.unionAll(written(more, "more_links"))
    labels = written(components(links), "components")

    ids = sets.where("class is not null").groupBy("class").agg(F.min(F.coalesce("doc_id", F.lit(_NO_ID))).alias("low"))
    ids = ids.join(labels, F.col("class") == F.col("node"), "left").select("class", F.coalesce("label", "class").alias("label"), "low")
    ids = written(ids, "classes")
    lows = ids.groupBy("label").agg(F.min("low").alias("component_id"))
    named = written(ids.join(written(lows, "lows").withColumnRenamed("label", "__label"), F.col("label") == F.col("__label")).select(
        F.col("class").alias("__class"), F.col("label").alias("group_id"), F.nullif("component_id", F.lit(_NO_ID)).alias("component_id")), "named")
    return sets.select("doc_id", *keep, "n", "class").join(named, F.col("class") == F.col("__class"), "left").select(
        "doc_id", *keep, F.col("n").alias("n_shingles"), F.col("class").alias("class_id"), "group_id",
        F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
