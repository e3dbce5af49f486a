"""Language model scores from a hierarchical Pitman-Yor process (operator 6).

Tokens are the words of a text (lower-cased A-Z) and one end. The restaurant of
a token is that of the two words before it, whole (the end stands for words
before the first); its parent is the restaurant of the one word before, whose
parent is the root. There are as many restaurants as the corpus has contexts.
Under the root, a word never seen in training is one event.

Seating follows the Chinese restaurant process. In a Gibbs sweep all customers
of each dish leave their restaurant and are seated again one after another,
given all other dishes; the tables they take are the customers of the parent
restaurant. (From 256 customers of a dish on, they are seated in runs with one
binomial draw each.) After ``burn_in`` sweeps, the predictive probabilities of
``samples`` sweeps are averaged.

Words are dealt to owners by a hash. A batch of texts (see exchange.py) sends
each owner its distinct words, and the owner answers with their numbers and
training counts; from then on a batch is a row of numbers. Its distinct
trigrams go to shards by the word before, so that a shard has whole restaurants
of one and of two words. A word before that is frequent is split over more
shards by the word that follows, so that no shard grows with it. What crosses
shards is added up by key in a table of totals: the customers of each word at
the root, and customers and tables of the restaurants of split words. Sweeps
run shard by shard; between them shards send their sums and get the totals. To
score, the batches ask the shards for their trigrams and the totals for their
words; no vocabulary and no table of restaurants is gathered in one place.

Defined results: a null text is empty and has the end only; a null id counts as
training; repeated rows are all counted and scored; without training tokens
every token is unknown; an empty table gives an empty result. Only id and text
are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .exchange import batches, held_batches, opened
from .tables import settled
from .words import hashed_words, mixed, starts_of

_END = b""  # the end of a text: no word is empty
_ONE_BY_ONE = 256
_RUNS = 32
_SHARDS = 3  # for each shuffle partition; a shard is worked on as a whole
_GROUP_ROWS = 8  # rows of a row group, where a row is a whole batch or shard
_ZSTD, _UNZSTD = zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()
_WORD, _ONE = -1, -2  # second part of a total's key: a word at the root, a restaurant of one word


@dataclass(frozen=True)
class Prior:
    """Discount and strength of the root, the one-word and the two-word restaurants."""

    discount: tuple[float, float, float] = (0.75, 0.75, 0.75)
    strength: tuple[float, float, float] = (1.0, 1.0, 1.0)


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 7."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7, F.lit(0)) == 2


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
    """Word id of each token, the words (the end is the last one), their hashes, and tokens per text."""
    value, start, end, lens, joined = hashed_words([t.lower() for t in texts])
    coded = pa.array(value).dictionary_encode()
    known, ids = coded.dictionary.to_numpy(), coded.indices.to_numpy()
    first = np.empty(len(known), np.int64)
    first[ids] = np.arange(len(ids))  # any place of each word
    uniq = [joined[a:b] for a, b in zip(start[first].tolist(), end[first].tolist(), strict=True)]
    spot = starts_of(lens)[1:] + np.arange(len(lens))  # where the ends go
    token = np.empty(len(ids) + len(lens), np.int64)
    is_end = np.zeros(len(token), bool)
    is_end[spot] = True
    token[~is_end], token[is_end] = ids, len(uniq)
    return token, [*uniq, _END], np.append(known, np.uint64(0)), lens + 1


def _by_number(token: np.ndarray, ids: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens by the rank of their word's number, and numbers and counts in that order: what is sorted in a batch is
    sorted everywhere."""
    order = np.argsort(ids)
    rank = np.empty(len(ids), np.int64)
    rank[order] = np.arange(len(ids))
    return rank[token], ids[order], count[order]


def _before(token: np.ndarray, lens: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The word one and two places before each token; before the first word of a text there are ends."""
    one = np.concatenate([[end], token[:-1]])
    two = np.concatenate([[end, end], token[:-2]])[:len(token)]
    two[starts_of(lens)[:-1]] = end
    return one, two


def _pack(*arrays: np.ndarray, words: list[bytes] = ()) -> bytes:
    """Words and arrays of whole numbers, each array byte plane by byte plane as far as its numbers reach."""
    parts, head = [b"\n".join(words)], [len(words)]
    for a in arrays:
        size = a.dtype.itemsize
        used = size if len(a) and a.min() < 0 else (int(a.max(initial=0)).bit_length() + 7) // 8
        planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), size)
        parts.append(b"".join(planes[:, i].tobytes() for i in range(used)))
        head += [len(a), used]
    return _ZSTD.compress(np.array([*head, len(parts[0])], "<u8").tobytes() + b"".join(parts))


def _unpack(body: bytes, *types: str) -> tuple[list[bytes], list[np.ndarray]]:
    flat = _UNZSTD.decompress(body)
    n_words, *sizes, n_bytes = np.frombuffer(flat, "<u8", 2 * len(types) + 2).tolist()
    first = 8 * (2 * len(types) + 2)
    at, arrays = first + n_bytes, []
    for n, used, t in zip(sizes[::2], sizes[1::2], types, strict=True):
        planes = np.zeros((n, np.dtype(t).itemsize), np.uint8)
        for i in range(used):
            planes[:, i] = np.frombuffer(flat, np.uint8, n, at)
            at += n
        arrays.append(planes.view(t).ravel())
    return (flat[first: first + n_bytes].split(b"\n") if n_words else []), arrays


def _owner(x: np.ndarray, n: int) -> np.ndarray:
    """One of n owners for each hash."""
    return (((x >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)


def _dealt(owner: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each owner that has something, with the places of what it has in their order."""
    owner = owner.astype(np.uint16 if n <= 1 << 16 else np.int64)  # small numbers are sorted by digits
    order = np.argsort(owner, kind="stable")
    at = np.searchsorted(owner[order], np.arange(n + 1))
    for k in range(n):
        if at[k] < at[k + 1]:
            yield k, order[at[k]: at[k + 1]]


def _find(sorted_keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where each wanted key is, or the place after the last one."""
    if not len(sorted_keys):
        return np.zeros(len(wanted), np.int64)
    near = np.minimum(np.searchsorted(sorted_keys, wanted), len(sorted_keys) - 1)
    return np.where(sorted_keys[near] == wanted, near, len(sorted_keys))


def _pair_keys(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs of two columns, sorted, and where each row is among them."""
    if len(x) and min(x.min(), y.min()) >= 0 and max(x.max(), y.max()) < 1 << 31:
        keys, at = np.unique(x << 31 | y, return_inverse=True)
        return keys >> 31, keys & (1 << 31) - 1, at
    xs, xi = np.unique(x, return_inverse=True)
    ys, yi = np.unique(y, return_inverse=True)
    keys, at = np.unique(xi * max(len(ys), 1) + yi, return_inverse=True)
    return xs[keys // max(len(ys), 1)], ys[keys % max(len(ys), 1)], at


def _narrow(x: np.ndarray) -> np.ndarray:
    """Whole numbers from 0 on in the smallest type that holds them, with a 0 after the last one."""
    return np.append(x, 0).astype(np.min_scalar_type(int(x.max(initial=0))))


def _firsts(x: np.ndarray) -> np.ndarray:
    """Whether each number differs from the one before."""
    return np.concatenate([[True], x[1:] != x[:-1]])[:len(x)]


_GRAM = ("<i8", "<u1", "<u4", "<i8", "<u4", "<i8", "<u8")


def _pack_grams(b: np.ndarray, w: np.ndarray, a: np.ndarray, times: np.ndarray, split: np.ndarray) -> bytes:
    """Trigrams (a, b, w) with equal (b, w) in sequence and equal b in sequence; ``split`` tells of b."""
    new_b = _firsts(b)
    new = new_b | _firsts(w)
    pair_at, b_at = np.flatnonzero(new), np.flatnonzero(new_b)
    per_pair = np.diff(pair_at, append=len(b))
    per_b = np.diff(np.searchsorted(pair_at, b_at), append=len(pair_at))
    return _pack(b[b_at].astype("<i8"), split[b_at].astype("<u1"), per_b.astype("<u4"), w[pair_at].astype("<i8"),
                 per_pair.astype("<u4"), a.astype("<i8"), times.astype("<u8"))


def _unpack_grams(body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    b, split, per_b, w, per_pair, a, times = _unpack(body, *_GRAM)[1]
    pair = np.repeat(np.arange(len(w)), per_pair)
    of_pair = np.repeat(np.arange(len(b)), per_b)
    return b[of_pair][pair], w[pair], a, times.astype(np.int64), split[of_pair][pair].astype(bool)


def seat(customers: np.ndarray, fresh: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables that the customers of each dish take when seated one after another; ``fresh`` is the weight of a new table.

    With i seated at t tables, the next one takes a new table with probability
    fresh / (i - discount * t + fresh).
    """
    more = np.flatnonzero(customers > 1)  # a single customer takes one table
    order = more[np.argsort(-customers[more], kind="stable")]
    c, a, t = customers[order], fresh[order], np.ones(len(order))
    for i in range(1, int(min(c[0], _ONE_BY_ONE)) if len(c) else 0):
        k = int(np.searchsorted(-c, -i, "left"))  # dishes with more than i customers
        t[:k] += rng.random(k) < a[:k] / (i - discount * t[:k] + a[:k])
    k = int(np.searchsorted(-c, -_ONE_BY_ONE, "left"))
    if k:
        at = np.full(k, float(_ONE_BY_ONE))
        for r in range(1, _RUNS + 1):
            to = np.floor(_ONE_BY_ONE * (c[:k] / _ONE_BY_ONE) ** (r / _RUNS) + 1e-9) if r < _RUNS else c[:k].astype(float)
            run, mid = np.maximum(to - at, 0), (at + to) / 2
            t[:k] += rng.binomial(run.astype(np.int64), a[:k] / (mid - discount * t[:k] + a[:k]))
            at = np.maximum(at, to)
    out = np.minimum(customers, 1.0)
    out[order] = np.minimum(t, c)
    return out


@dataclass
class _Dishes:
    """The dishes of two-word contexts and, as their parents, those of one-word contexts."""

    words: list[bytes] | np.ndarray
    context: np.ndarray
    count: np.ndarray
    parent_of: np.ndarray  # the parent of each context
    parent: np.ndarray  # the parent's dish of each dish
    parent_word: np.ndarray
    parent_context: np.ndarray


class _Part(_Dishes):
    """Dishes by keys, word * contexts + context; 65536 contexts, 256 of each parent in turn."""

    def __init__(self, words: list[bytes], keys: np.ndarray, count: np.ndarray) -> None:
        word, context = keys >> 16, keys & 0xFFFF
        self.parent_keys, parent = np.unique(word * 256 + context // 256, return_inverse=True)
        super().__init__(words, context, count, np.arange(1 << 16) // 256, parent, self.parent_keys // 256, self.parent_keys % 256)


@dataclass
class _Totals:
    """Customers and tables of each restaurant (the root's tables are the words)."""

    customers: np.ndarray
    tables: np.ndarray
    parent_tables: np.ndarray
    words: int
    parent_customers: np.ndarray | None = None  # if not given: every context is there, in order of the parents
    root_customers: float | None = None

    def __post_init__(self) -> None:
        if self.parent_customers is None:
            self.parent_customers = self.tables.reshape(len(self.parent_tables), -1).sum(1)
        if self.root_customers is None:
            self.root_customers = float(self.parent_tables.sum())


def _predict(x: _Totals, prior: Prior, root: np.ndarray, parent: tuple[np.ndarray, np.ndarray], parent_context: np.ndarray,
             own: tuple[np.ndarray, np.ndarray], context: np.ndarray) -> np.ndarray:
    """Probability of a word in a context: customers of the word at the root (0: unknown), and customers and tables
    of the word in the parent and in the context."""
    (d0, d1, d2), (s0, s1, s2) = prior.discount, prior.strength
    p = np.where(root > 0, root - d0, s0 + d0 * x.words) / (s0 + x.root_customers)
    p = (parent[0] - d1 * parent[1] + (s1 + d1 * x.parent_tables[parent_context]) * p) / (s1 + x.parent_customers[parent_context])
    return (own[0] - d2 * own[1] + (s2 + d2 * x.tables[context]) * p) / (s2 + x.customers[context])


def _sweep(part: _Dishes, tables: np.ndarray | None, parent_tables: np.ndarray | None, x: _Totals, prior: Prior,
           rng: np.random.Generator, root: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Tables of each (word, context) and each (word, parent) after all customers were seated again.

    ``root``: customers of each word at the root, if the part has not all of them.
    """
    (d0, d1, d2), (s0, s1, s2) = prior.discount, prior.strength
    if tables is None:  # before the first sweep each dish has one table everywhere
        tables, parent_tables = np.ones(len(part.context)), np.ones(len(part.parent_word))
    customers = np.bincount(part.parent, tables, len(part.parent_word))
    if root is None:
        root = np.bincount(part.parent_word, parent_tables, len(part.words))
    p = ((root - d0) / (s0 + x.root_customers))[part.parent_word]
    in_parent = (customers - d1 * parent_tables + (s1 + d1 * x.parent_tables[part.parent_context]) * p) / (s1 + x.parent_customers[part.parent_context])
    new = seat(part.count, (s2 + d2 * x.tables[part.context]) * in_parent[part.parent], d2, rng)
    customers = np.bincount(part.parent, new, len(part.parent_word))
    return new, seat(customers, (s1 + d1 * x.parent_tables[part.parent_context]) * p, d1, rng)


_SUM = ("<i8", "<i8", "<u8", "<u8")


def _key_owner(x: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    return _owner(mixed(mixed(x.astype(np.uint64)) + y.astype(np.uint64)), n)


class _Shard:
    """The trigrams of a shard: dishes of two-word restaurants (``part``), and which sums other shards share."""

    def __init__(self, body: bytes) -> None:
        b, w, a, count, split = _unpack_grams(body)  # sorted by b, w and a
        new_b = _firsts(b)
        new = new_b | _firsts(w)
        one, pair = np.cumsum(new_b) - 1, np.cumsum(new) - 1
        self.ones, self.split = b[new_b], split[new_b]
        self.words, word = np.unique(w[new], return_inverse=True)
        parent_of, two, context = _pair_keys(one, a)
        self.befores, at = np.unique(two, return_inverse=True)
        self.context_keys = parent_of * len(self.befores) + at  # sorted
        self.part = _Dishes(self.words, context, count, parent_of, pair, word, one[new])
        self.split_two = self.split[parent_of]
        self.x = np.concatenate([self.words, self.ones[self.split], two[self.split_two]])
        self.y = np.concatenate([np.full(len(self.words), _WORD), np.full(int(self.split.sum()), _ONE), self.ones[parent_of[self.split_two]]])

    def sums(self, own: np.ndarray, parent: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Customers and tables of the two-word and the one-word restaurants, and customers of words at the root."""
        p = self.part
        tables = np.bincount(p.context, own, len(p.parent_of))
        return (np.bincount(p.context, p.count, len(p.parent_of)), tables, np.bincount(p.parent_of, tables, len(self.ones)),
                np.bincount(p.parent_context, parent, len(self.ones)), np.bincount(p.parent_word, parent, len(self.words)))

    def crossing(self, own: np.ndarray, parent: np.ndarray, n: int) -> Iterator[tuple[int, bytes]]:
        """(owner, body) of the sums to be added to those of other shards."""
        c, t, pc, pt, root = self.sums(own, parent)
        customers = np.concatenate([root, pc[self.split], c[self.split_two]])
        tables = np.concatenate([np.zeros(len(root)), pt[self.split], t[self.split_two]])
        for j, at in _dealt(_key_owner(self.x, self.y, n), n):
            yield j, _pack(self.x[at].astype("<i8"), self.y[at].astype("<i8"), customers[at].astype("<u8"), tables[at].astype("<u8"))

    def totals(self, own: np.ndarray, parent: np.ndarray, added: dict[int, bytes], n: int, n_words: int, root_customers: float) -> tuple[_Totals, np.ndarray]:
        """Totals of the restaurants and customers of the words at the root, over all shards."""
        c, t, pc, pt, root = self.sums(own, parent)
        customers, tables = np.zeros(len(self.x)), np.zeros(len(self.x))
        for j, at in _dealt(_key_owner(self.x, self.y, n), n):
            customers[at], tables[at] = _unpack(added[j], "<u8", "<u8")[1]
        i, j = len(root), len(root) + int(self.split.sum())
        pc[self.split], pt[self.split] = customers[i:j], tables[i:j]
        c[self.split_two], t[self.split_two] = customers[j:], tables[j:]
        return _Totals(c, t, pt, n_words, pc, root_customers), customers[:i]

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys of the dishes (parent's dish and context) and of the parents' dishes (parent and word), both sorted."""
        p = self.part
        return p.parent * len(p.parent_of) + p.context, p.parent_context * len(self.words) + p.parent_word

    def places(self, b: np.ndarray, w: np.ndarray, a: np.ndarray, keys: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, ...]:
        """Where trigrams are: dish and context, and for each (b, w) parent's dish and parent; the place after the last
        if not there."""
        new_b = _firsts(b)
        new = new_b | _firsts(w)
        n, pair = len(self.part.parent_of), np.cumsum(new) - 1
        one = _find(self.ones, b[new_b])[(np.cumsum(new_b) - 1)[new]]
        word, two = _find(self.words, w[new]), _find(self.befores, a)
        up = _find(keys[1], np.where((word < len(self.words)) & (one < len(self.ones)), one * len(self.words) + word, -1))
        context = _find(self.context_keys, np.where((one[pair] < len(self.ones)) & (two < len(self.befores)), one[pair] * len(self.befores) + two, -1))
        dish = _find(keys[0], np.where((up[pair] < len(keys[1])) & (context < n), up[pair] * n + context, -1))
        return dish, context, up, one


class _Batch:
    """The distinct trigrams of an encoded batch, and the totals it needs."""

    def __init__(self, body: bytes, n: int, split_at: int, used: np.ndarray | None = None) -> None:
        self.n, self.shards = n, n * _SHARDS
        token, self.lens, ids, count = [a.astype(np.int64) for a in _unpack(body, "<u4", "<u4", "<u8", "<u8")[1]]
        self.count_of_token = count[token]
        size = len(ids)
        one, two = _before(token, self.lens, int(token[self.lens[0] - 1]))  # the last token of a text is the end
        if used is not None:
            token, one, two = token[used], one[used], two[used]
        pairs, at = np.unique(one * size + token, return_inverse=True)
        grams, self.of_token, self.times = np.unique(at * size + two, return_inverse=True, return_counts=True)
        self.pair, before = grams // size, grams % size
        first, self.pair_word = pairs // size, pairs % size
        self.b, self.w, self.a = ids[first], ids[self.pair_word], ids[before]
        slots = (1 + count[first] // split_at).astype(np.uint64)
        self.split = slots > 1
        self.shard = _owner(mixed(mixed(self.b.astype(np.uint64)) + mixed(self.w.astype(np.uint64)) % slots), self.shards)
        # totals: all words, split words before, contexts of split words
        split_gram = self.split[self.pair]
        ones, self.one_at = np.unique(first[self.split], return_inverse=True)
        twos, self.two_at = np.unique((first[self.pair] * size + before)[split_gram], return_inverse=True)
        self.split_gram, self.n_words, self.n_ones = split_gram, size, len(ones)
        self.x = np.concatenate([ids, ids[ones], ids[twos % size]])
        self.y = np.concatenate([np.full(size, _WORD), np.full(len(ones), _ONE), ids[twos // size]])

    def to_shards(self) -> Iterator[tuple[int, np.ndarray]]:
        return _dealt(self.shard[self.pair], self.shards)

    def question(self, at: np.ndarray) -> bytes:
        pair = self.pair[at]
        return _pack_grams(self.b[pair], self.w[pair], self.a[at], self.times[at], self.split[pair])

    def to_totals(self) -> Iterator[tuple[int, np.ndarray]]:
        return _dealt(_key_owner(self.x, self.y, self.n), self.n)


def _rows(schema: list[tuple[str, pa.DataType]], *columns: list) -> pa.Table:
    return pa.table({name: pa.array(c, t) for (name, t), c in zip(schema, columns, strict=True)})


_ASKED = [("batch", pa.string()), ("owner", pa.int32()), ("body", pa.binary())]
_ASKED_SQL = "batch string, owner int, body binary"
_PARTS = [("shard", pa.int32()), ("kind", pa.int32()), ("owner", pa.int32()), ("body", pa.binary())]
_PARTS_SQL = "shard int, kind int, owner int, body binary"
_MODEL, _SEATS, _CROSSING = 0, 1, 2


def scores(docs: DataFrame, prior: Prior = Prior(), burn_in: int = 1, samples: int = 2, seed: int = 17, doc_id: str = "doc_id",
           text: str = "text", split_at: int = 1 << 20) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10).

    A word is split over one more shard for every ``split_at`` times it occurs in training.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ident = F.col(f"`{doc_id}`")
    src = docs.select(F.col(f"`{text}`").alias("text"), ident.alias("doc_id"), held_out(ident).alias("held_out"))

    def send_words(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, rows, texts in batches(stream):
            token, uniq, known, lens = _tokens(texts)
            used = ~np.repeat(rows.column(2).to_numpy(zero_copy_only=False), lens)
            count = np.bincount(token[used], minlength=len(uniq)).astype("<u4")
            got = [(k, _pack(count[at], words=[uniq[i] for i in at.tolist()])) for k, at in _dealt(_owner(known, n), n)]
            yield from _rows(_ASKED, [name] * len(got), [k for k, _ in got], [b for _, b in got]).to_batches()

    def number(group: pa.Table) -> pa.Table:
        place: dict[bytes, int] = {}
        asked, counts = [], []
        for body in group["body"].to_pylist():
            words, (count,) = _unpack(body, "<u4")
            for w in words:
                place.setdefault(w, len(place))
            asked.append(np.fromiter(map(place.__getitem__, words), np.int64, len(words)))
            counts.append(count)
        total = np.bincount(np.concatenate(asked), np.concatenate(counts), len(place)).astype("<u8")
        words, counted = list(place), total.tolist()
        ids = np.empty(len(words), "<u8")  # frequent words first, which packs well, then by the word, so that reruns agree
        ids[sorted(range(len(words)), key=lambda i: (-counted[i], words[i]))] = np.arange(len(words)) * n + group["owner"][0].as_py()
        return _rows(_ASKED, group["batch"].to_pylist(), group["owner"].to_pylist(), [_pack(ids[at], total[at]) for at in asked])

    def encode(held: pa.Table, answered: pa.Table) -> pa.Table:
        rows, texts, changed = opened(held, answered)
        bodies = dict(zip(answered["owner"].to_pylist(), answered["body"].to_pylist(), strict=True))
        token, uniq, known, lens = _tokens(texts)
        ids, count = np.empty(len(uniq), "<u8"), np.empty(len(uniq), "<u8")
        for k, at in _dealt(_owner(known, n), n):
            if k not in bodies:
                raise changed
            ids[at], count[at] = _unpack(bodies[k], "<u8", "<u8")[1]
        token, ids, count = _by_number(token, ids, count)
        kept, sink = rows.select([1, 2]), pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, kept.schema) as writer:
            writer.write_batch(kept)
        training = int(lens[~rows.column(2).to_numpy(zero_copy_only=False)].sum())
        return pa.table({
            "batch": held["batch"], "training": pa.array([training], pa.int64()), "rows": pa.array([sink.getvalue().to_pybytes()], pa.binary()),
            "body": pa.array([_pack(token.astype("<u4"), lens.astype("<u4"), ids, count)], pa.binary()),
        })

    numbers = src.mapInArrow(send_words, _ASKED_SQL).groupBy("owner").applyInArrow(number, _ASKED_SQL)
    encoded = held_batches(src).groupBy("batch").cogroup(numbers.groupBy("batch")).applyInArrow(
        encode, "batch string, training long, rows binary, body binary")
    encoded = settled(encoded, "pitman_yor_batches", _GROUP_ROWS)
    n_train = encoded.agg(F.sum("training").alias("n")).first()["n"] or 0

    def ident_rows(body: bytes) -> pa.RecordBatch:
        return pa.ipc.open_stream(body).read_all().combine_chunks().to_batches()[0]

    def ask(training: bool):
        """Questions to the shards, for training tokens or for all; then also those to the owners of totals, who come after the shards."""
        def send(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for found in stream:
                for r in found.to_pylist():
                    used = None
                    if training:
                        rows = ident_rows(r["rows"])
                        used = ~np.repeat(rows.column(1).to_numpy(zero_copy_only=False), _unpack(r["body"], "<u4", "<u4", "<u8", "<u8")[1][1])
                    batch = _Batch(r["body"], n, split_at, used)
                    got = [(k, batch.question(at)) for k, at in batch.to_shards()]
                    if not training:
                        got += [(batch.shards + k, _pack(batch.x[at].astype("<i8"), batch.y[at].astype("<i8"))) for k, at in batch.to_totals()]
                    yield from _rows(_ASKED, [r["batch"]] * len(got), [k for k, _ in got], [b for _, b in got]).to_batches()

        return encoded.select("batch", "rows", "body").mapInArrow(send, _ASKED_SQL)

    def parts_of(k: int, shard: _Shard, own: np.ndarray, parent: np.ndarray, kind: int, body: bytes) -> pa.Table:
        sums = list(shard.crossing(own, parent, n))
        return _rows(_PARTS, [k] * (1 + len(sums)), [kind] + [_CROSSING] * len(sums), [-1] + [j for j, _ in sums], [body] + [s for _, s in sums])

    def merge(group: pa.Table) -> pa.Table:
        def merged() -> bytes:  # what it needs is gone before the shard is built
            b, w, a, times, split = [np.concatenate(c) for c in zip(*map(_unpack_grams, group["body"].to_pylist()), strict=True)]
            pair_b, pair_w, at = _pair_keys(b, w)
            del b, w
            pair_split = np.zeros(len(pair_b), bool)
            pair_split[at] = split
            pair, a, at = _pair_keys(at, a)
            count = np.bincount(at, times, len(pair)).astype(np.int64)
            del at, times, split
            return _pack_grams(pair_b[pair], pair_w[pair], a, count, pair_split[pair])

        body = merged()
        shard = _Shard(body)
        return parts_of(group["owner"][0].as_py(), shard, np.ones(len(shard.part.context)), np.ones(len(shard.part.parent_word)), _MODEL, body)

    def add(group: pa.Table) -> pa.Table:
        got = [_unpack(body, *_SUM)[1] for body in group["body"].to_pylist()]
        x, y, customers, tables = [np.concatenate(c) for c in zip(*got, strict=True)]
        x, y, at = _pair_keys(x, y)
        c, t = np.bincount(at, customers, len(x)).astype("<u8"), np.bincount(at, tables, len(x)).astype("<u8")
        bodies = [_pack(c[i], t[i]) for i in np.split(at, np.cumsum([len(g[0]) for g in got])[:-1])]
        word, k = y == _WORD, len(got)
        return _rows(_PARTS, [*group["shard"].to_pylist(), -1], [_CROSSING] * (k + 1), [*group["owner"].to_pylist(), group["owner"][0].as_py()],
                     [*bodies, _pack(x.astype("<i8"), y.astype("<i8"), c, t)]).append_column(
            "root", pa.array([0] * k + [int(c[word].sum())], pa.int64())).append_column("words", pa.array([0] * k + [int(word.sum())], pa.int64()))

    def added(parts: DataFrame, name: str) -> tuple[DataFrame, int, int]:
        """The totals, as answers to the shards and (shard -1) by owner, with the root's customers and words."""
        got = parts.where(F.col("kind") == _CROSSING).groupBy("owner").applyInArrow(add, _PARTS_SQL + ", root long, words long")
        got = settled(got, name)
        total = got.agg(F.sum("root").alias("root"), F.sum("words").alias("words")).first()
        return got, total["root"] or 0, total["words"] or 0

    model = settled(ask(training=True).groupBy("owner").applyInArrow(merge, _PARTS_SQL), "pitman_yor_model", _GROUP_ROWS)
    totals, root_customers, n_words = added(model, "pitman_yor_totals")
    model = model.where(F.col("kind") == _MODEL)

    def sweep(s: int, root_customers: int):
        def run(group: pa.Table) -> pa.Table:
            rows = group.to_pylist()
            body = {r["kind"]: r["body"] for r in rows}
            shard, k = _Shard(body[_MODEL]), rows[0]["shard"]
            if s:
                own, parent = [x.astype(float) for x in _unpack(body[_SEATS], "<u4", "<u4")[1]]
            else:
                own, parent = np.ones(len(shard.part.context)), np.ones(len(shard.part.parent_word))
            sums = {r["owner"]: r["body"] for r in rows if r["kind"] == _CROSSING}
            x, root = shard.totals(own, parent, sums, n, n_words, float(root_customers))
            own, parent = _sweep(shard.part, own, parent, x, prior, np.random.default_rng([seed, s, k]), root)
            return parts_of(k, shard, own, parent, _SEATS, _pack(own.astype("<u4"), parent.astype("<u4")))

        return run

    kept: list[tuple[DataFrame, DataFrame, int]] = []
    seats = None
    for s in range(burn_in + samples):
        given = model.unionAll(totals.where("shard >= 0").select(*model.columns))
        if seats is not None:
            given = given.unionAll(seats)
        made = settled(given.groupBy("shard").applyInArrow(sweep(s, root_customers), _PARTS_SQL), f"pitman_yor_sweep{s}")
        seats = made.where(F.col("kind") == _SEATS)
        totals, root_customers, _ = added(made, f"pitman_yor_totals{s}")
        if s >= burn_in:
            kept.append((seats, totals.where("shard < 0"), root_customers))
    root_sums = [float(r) for _, _, r in kept]

    def answer(group: pa.Table, owned: pa.Table) -> pa.Table:
        held = dict(zip(owned["nth"].to_pylist(), owned["body"].to_pylist(), strict=True))
        shard = _Shard(held.pop(0)) if held else None
        keys, known = shard.keys() if shard else None, []
        for _, body in sorted(held.items()):
            own, parent = [x.astype(float) for x in _unpack(body, "<u4", "<u4")[1]]
            _, t, pc, pt, _ = shard.sums(own, parent)
            known.append([_narrow(x) for x in (own, t, np.bincount(shard.part.parent, own, len(parent)), parent, pc, pt)])
        if shard:
            count, customers = _narrow(shard.part.count), _narrow(np.bincount(shard.part.context, shard.part.count, len(shard.part.parent_of)))
        bodies = []
        for body in group["body"].to_pylist():
            b, w, a, _, _ = _unpack_grams(body)
            if shard is None:
                n_pairs = int((_firsts(b) | _firsts(w)).sum())
                found = [np.zeros(len(b), np.uint8)] * (2 + 2 * samples) + [np.zeros(n_pairs, np.uint8)] * (4 * samples)
            else:
                dish, context, up, one = shard.places(b, w, a, keys)
                found = [count[dish], customers[context]]
                found += [x for k in known for x in (k[0][dish], k[1][context])]
                found += [x for k in known for x in (k[2][up], k[3][up], k[4][one], k[5][one])]
            bodies.append(_pack(*found))
        return _rows(_ASKED, group["batch"].to_pylist(), group["owner"].to_pylist(), bodies)

    def look_up(group: pa.Table, owned: pa.Table) -> pa.Table:
        held = dict(zip(owned["nth"].to_pylist(), owned["body"].to_pylist(), strict=True))
        tables = []
        for _, body in sorted(held.items()):
            x, y, c, t = _unpack(body, *_SUM)[1]
            xs, ys = np.unique(x), np.unique(y)
            tables.append((xs, ys, np.searchsorted(xs, x) * len(ys) + np.searchsorted(ys, y), np.append(c, 0), np.append(t, 0)))
        bodies = []
        for body in group["body"].to_pylist():
            x, y = _unpack(body, "<i8", "<i8")[1]
            found = [] if tables else [np.zeros(len(x))] * (2 * samples)
            for xs, ys, keys, c, t in tables:
                i, j = _find(xs, x), _find(ys, y)
                at = _find(keys, np.where((i < len(xs)) & (j < len(ys)), i * len(ys) + j, -1))
                found += [c[at], t[at]]
            bodies.append(_pack(*[x.astype("<u8") for x in found]))
        return _rows(_ASKED, group["batch"].to_pylist(), group["owner"].to_pylist(), bodies)

    def answer_or_look_up(group: pa.Table, owned: pa.Table) -> pa.Table:
        if not group.num_rows:
            return _rows(_ASKED, [], [], [])
        return (answer if group["owner"][0].as_py() < n * _SHARDS else look_up)(group, owned)

    owned = model.select(F.col("shard").alias("owner"), F.lit(0).alias("nth"), "body")
    for i, (seating, total, _) in enumerate(kept):
        owned = owned.unionAll(seating.select(F.col("shard").alias("owner"), F.lit(i + 1).alias("nth"), "body"))
        owned = owned.unionAll(total.select((F.col("owner") + n * _SHARDS).alias("owner"), F.lit(i).alias("nth"), "body"))
    answers = ask(training=False).groupBy("owner").cogroup(owned.groupBy("owner")).applyInArrow(answer_or_look_up, _ASKED_SQL)

    def finish(held: pa.Table, got: pa.Table) -> pa.Table:
        bodies = {r["owner"]: r["body"] for r in got.to_pylist()}
        rows = ident_rows(held["rows"][0].as_py())
        batch = _Batch(held["body"][0].as_py(), n, split_at)
        n_grams, n_pairs = len(batch.pair), len(batch.b)
        gram, pair = np.zeros((2 + 2 * samples, n_grams)), np.zeros((4 * samples, n_pairs))
        for k, at in batch.to_shards():
            found = _unpack(bodies[k], *["<u8"] * (2 + 6 * samples))[1]
            gram[:, at] = found[:2 + 2 * samples]
            pair[:, batch.pair[at][_firsts(batch.pair[at])]] = found[2 + 2 * samples:]
        total = np.zeros((2 * samples, len(batch.x)))
        for k, at in batch.to_totals():
            total[:, at] = _unpack(bodies[batch.shards + k], *["<u8"] * (2 * samples))[1]
        i, j, split = batch.n_words, batch.n_words + batch.n_ones, batch.split_gram
        p = np.zeros(n_grams)
        for s in range(samples):
            customers, tables = total[2 * s], total[2 * s + 1]
            gram[1, split], gram[3 + 2 * s, split] = customers[j:][batch.two_at], tables[j:][batch.two_at]
            own_customers, own_tables, parent_customers, parent_tables = pair[4 * s: 4 * s + 4]
            parent_customers[batch.split], parent_tables[batch.split] = customers[i:j][batch.one_at], tables[i:j][batch.one_at]
            x = _Totals(gram[1], gram[3 + 2 * s], parent_tables, n_words, parent_customers, root_sums[s])
            root = customers[:i][batch.pair_word][batch.pair]
            p += _predict(x, prior, root, (own_customers[batch.pair], own_tables[batch.pair]), batch.pair, (gram[0], gram[2 + 2 * s]), np.arange(n_grams))
        known = batch.count_of_token
        base = np.log10((known + 1) / (n_train + n_words + 1))
        at = starts_of(batch.lens)[:-1]
        return pa.table({
            "doc_id": rows.column(0), "held_out": rows.column(1), "n_tokens": pa.array(batch.lens, pa.int64()),
            "n_known": pa.array(np.add.reduceat((known > 0).astype(np.int64), at), pa.int64()),
            "train_tokens": pa.array([n_train] * len(at), pa.int64()),
            "base_score": pa.array(np.add.reduceat(base, at), pa.float64()),
            "score": pa.array(np.add.reduceat(np.log10(p / samples)[batch.of_token], at), pa.float64()),
        })

    kind = src.schema["doc_id"].dataType.simpleString()
    return encoded.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(
        finish, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
