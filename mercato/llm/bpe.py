"""Byte-pair encoding and decoding with a public tokenizer file (operator 11).

A text is cut at the file's added tokens, then into words by the pattern of
byte-level BPE; each distinct word of a batch is encoded once. The bytes of all
distinct words lie in one flat array of symbol ids. A merge round looks pairs of
neighbours up by binary search among the sorted pair keys, finds each word's
lowest rank, and joins all its pairs of that rank from left to right. Words that
are still open after ``ROUNDS`` rounds (runs of letters without any break) go on
in rounds of one rank over all of them, which touch only the places that change,
so that a word costs no more for being long. A pair of a merged symbol always
has a higher rank than the merge that made it (checked when the file is read),
so both orders give what one merge after another gives.

Defined results: a null text is encoded like an empty one, as no ids; added
tokens written out in a text are encoded as such; repeated rows, and rows
with equal ids, are each encoded; an empty table gives an empty result. Ids
are unsigned 32-bit integers, little-endian, one after another. Unknown ids
are an error when decoding; bytes that are no UTF-8 become U+FFFD. Only the
text and the columns in ``keep`` are read.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .words import starts_of, steps

FILE = "byte_bpe_50k.json"
ROUNDS = 48
STEP_BYTES = 4_000_000
_NONE = np.int64(1 << 40)  # the rank of a pair that no merge joins

#: Letters and digits that Unicode has had since version 17. The library's tables end with version 16 and take them for neither.
_NEW = [
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F), (0x209D, 0x209F), (0xA7CE, 0xA7CF),
    (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF),
    (0x10940, 0x10959), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1),
    (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF6), (0x187F8, 0x187FF),
    (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168),
    (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2),
    (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD),
    (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
]


def _pattern(letter: str, digit: str, other: str) -> regex.Pattern:
    return regex.compile(rf" ?{letter}++|'(?:[sdmt]|ll|ve|re)| ?{digit}++| ?{other}++|\s+(?!\S)|\s+", regex.V1)


@lru_cache(maxsize=1)
def _patterns() -> tuple[re.Pattern, regex.Pattern, regex.Pattern, re.Pattern]:
    """The same pattern for ASCII texts, for others, and for those with characters in ``_NEW``; and what finds these."""
    new = "[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in _NEW) + "]"
    ascii_ = re.compile(r" ?[A-Za-z]+|'(?:[sdmt]|ll|ve|re)| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")
    plain = _pattern(r"\p{L}", r"\p{N}", r"[^\s\p{L}\p{N}]")
    old = _pattern(rf"[\p{{L}}--{new}]", rf"[\p{{N}}--{new}]", rf"[[^\s\p{{L}}\p{{N}}]||{new}]")
    return ascii_, plain, old, re.compile(new)


def split_words(text: str) -> list[str]:
    """The words of byte-level BPE, white space included; together they are the text."""
    ascii_, plain, old, new = _patterns()
    return (ascii_ if text.isascii() else old if new.search(text) else plain).findall(text)


@dataclass(frozen=True)
class Tables:
    """What encoding and decoding need of a tokenizer file; its size is that of the vocabulary."""

    byte_id: np.ndarray  # id of each single byte
    keys: np.ndarray  # left * size + right of each merge, sorted
    ranks: np.ndarray  # its rank
    made: np.ndarray  # by rank: the id that the merge makes
    pieces: tuple  # by id: bytes (None: no such id)
    added: dict  # text of each added token: id

    @property
    def size(self) -> int:
        return len(self.pieces)


def _byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones themselves, the others from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def read_tables(path: str) -> Tables:
    """Read a tokenizer file (JSON, byte-level BPE). Options that would change the result and are not done here are errors."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    model, pre = file["model"], file.get("pre_tokenizer") or {}
    odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
    if model.get("type", "BPE") != "BPE" or odd or file.get("normalizer"):
        raise ValueError(f"{path}: no plain BPE model: {odd or model.get('type') or 'normalizer'}")
    if pre.get("type") != "ByteLevel" or not pre.get("use_regex", True) or pre.get("add_prefix_space") or (file.get("decoder") or {}).get("type") != "ByteLevel":
        raise ValueError(f"{path}: words are not cut as in byte-level BPE")
    letters, vocab = _byte_letters(), model["vocab"]
    pieces: list[bytes | None] = [None] * (1 + max([*vocab.values(), *[a["id"] for a in file.get("added_tokens", [])]]))
    for text, i in vocab.items():
        if all(c in letters for c in text):
            pieces[i] = bytes(letters[c] for c in text)
        else:
            pieces[i] = text.encode()
    added = {}
    for a in file.get("added_tokens", []):
        if a.get("lstrip") or a.get("rstrip") or a.get("single_word") or a.get("normalized"):
            raise ValueError(f"{path}: added token {a['content']!r} takes in more than its own text")
        added[a["content"]] = a["id"]
        pieces[a["id"]] = a["content"].encode()
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    left = np.array([vocab[a] for a, _ in pairs], np.int64)
    right = np.array([vocab[b] for _, b in pairs], np.int64)
    made = np.array([vocab[a + b] for a, b in pairs], np.int64)
    by_made = np.full(len(pieces), -1, np.int64)
    by_made[made] = np.arange(len(pairs))
    if len(np.unique(made)) < len(pairs) or np.any(np.maximum(by_made[left], by_made[right]) >= np.arange(len(pairs))):
        raise ValueError(f"{path}: a merge uses a symbol of a later merge")
    keys = left * len(pieces) + right
    order = np.argsort(keys)
    byte_id = np.array([vocab[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])], np.int64)
    return Tables(byte_id, keys[order], order.astype(np.int64), made, tuple(pieces), added)


def _ranks(tables: Tables, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The rank of each pair, by binary search."""
    if not len(tables.keys):
        return np.full(len(left), _NONE)
    key = left * tables.size + right
    at = np.minimum(np.searchsorted(tables.keys, key), len(tables.keys) - 1)
    return np.where(tables.keys[at] == key, tables.ranks[at], _NONE)


def _every_second(at: np.ndarray, follows: np.ndarray) -> np.ndarray:
    """Of places in order, the first, third, ... of each chain of neighbours (``follows``: is next to the one before)."""
    k = np.arange(len(at))
    return at[(k - np.maximum.accumulate(np.where(follows, 0, k))) % 2 == 0]


def encode_words(tables: Tables, words: list[bytes], rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words, one word after another, and the number of ids of each."""
    lens = np.fromiter(map(len, words), np.int64, len(words))
    counts = lens.copy()
    symbol = tables.byte_id[np.frombuffer(b"".join(words), np.uint8)]
    word = np.repeat(np.arange(len(words)), lens)
    done: list[tuple[np.ndarray, np.ndarray]] = []  # word and symbol of words that are ready
    last = np.ones(len(word), bool)
    last[:-1] = word[1:] != word[:-1]
    rank = np.full(len(word), _NONE)
    inner = np.flatnonzero(~last)
    rank[inner] = _ranks(tables, symbol[inner], symbol[inner + 1])
    del inner, last
    for _ in range(rounds):
        if not len(symbol):
            break
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        size = np.diff(first, append=len(word))
        best = np.minimum.reduceat(rank, first)
        ready = np.repeat(best == _NONE, size)
        if ready.any():
            done.append((word[ready], symbol[ready]))
            symbol, word, rank = symbol[~ready], word[~ready], rank[~ready]
            size, best = size[best != _NONE], best[best != _NONE]
            if not len(symbol):
                break
        hit = np.flatnonzero(rank == np.repeat(best, size))
        hit = _every_second(hit, np.diff(hit, prepend=-9) == 1)
        symbol[hit] = tables.made[rank[hit]]
        keep = np.ones(len(symbol), bool)
        keep[hit + 1] = False
        hit = hit - np.arange(len(hit))  # each merge before has taken one place
        symbol, word, rank = symbol[keep], word[keep], rank[keep]
        rank[hit] = _NONE
        near = np.concatenate([hit, hit[hit > 0] - 1])
        near = near[near + 1 < len(word)]
        near = near[word[near] == word[near + 1]]
        rank[near] = _ranks(tables, symbol[near], symbol[near + 1])
    if len(symbol):
        done.append(_in_rank_order(tables, symbol, word, rank))
    if not done:
        return np.zeros(0, np.int64), counts
    word, symbol = (np.concatenate(x) for x in zip(*done, strict=True))
    return symbol[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(words))


def _distinct(at: np.ndarray) -> np.ndarray:
    at = np.sort(at)
    return at[np.concatenate([[True], at[1:] != at[:-1]])] if len(at) else at


def _in_rank_order(tables: Tables, symbol: np.ndarray, word: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Finish words in rounds of one rank, lowest first; symbols are linked, and places wait by the rank of their pair."""
    n = len(symbol)
    after = np.arange(1, n + 1)
    after[np.flatnonzero(np.append(word[1:] != word[:-1], True))] = -1
    before = np.full(n, -1)
    before[after[after >= 0]] = np.flatnonzero(after >= 0)
    alive = np.ones(n, bool)
    waiting: dict[int, list[np.ndarray]] = {}
    ranks: list[int] = []

    def wait(at: np.ndarray) -> None:
        at = at[rank[at] < _NONE]
        at = at[np.argsort(rank[at], kind="stable")]
        cut = np.flatnonzero(np.diff(rank[at])) + 1
        for r, places in zip(rank[at[np.concatenate([[0], cut])]].tolist() if len(at) else [], np.split(at, cut), strict=False):
            if r not in waiting:
                waiting[r] = []
                heapq.heappush(ranks, r)
            waiting[r].append(places)

    wait(np.arange(n))
    while ranks:
        r = heapq.heappop(ranks)
        at = _distinct(np.concatenate(waiting.pop(r)))
        at = at[alive[at] & (rank[at] == r)]
        if not len(at):
            continue
        at = _every_second(at, np.concatenate([[False], after[at[:-1]] == at[1:]]))
        gone = after[at]
        alive[gone] = False
        symbol[at] = tables.made[r]
        after[at] = after[gone]
        onward = after[at] >= 0
        before[after[at[onward]]] = at[onward]
        near = _distinct(np.concatenate([at, before[at]]))
        near = near[near >= 0]
        rank[near] = _NONE
        near = near[after[near] >= 0]
        rank[near] = _ranks(tables, symbol[near], symbol[after[near]])
        wait(near)
    return word[alive], symbol[alive]


def encode_texts(tables: Tables, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, one text after another, and the number of ids of each."""
    cut = re.compile("|".join(map(re.escape, sorted(tables.added, key=len, reverse=True)))) if tables.added else None
    known: dict[str, int] = {}
    flat: list[int] = []  # numbers of words; added tokens as -1 - id
    sizes = []
    for text in texts:
        n, at = len(flat), 0
        for m in cut.finditer(text) if cut else ():
            flat.extend([known.setdefault(w, len(known)) for w in split_words(text[at: m.start()])])
            flat.append(-1 - tables.added[m.group()])
            at = m.end()
        flat.extend([known.setdefault(w, len(known)) for w in split_words(text[at:] if at else text)])
        sizes.append(len(flat) - n)
    ids, counts = encode_words(tables, [w.encode() for w in known])
    used = np.array(flat, np.int64)
    own = sorted({x for x in flat if x < 0}) if tables.added else []
    if own:  # added tokens become further words of one id
        used = np.where(used < 0, len(known) + np.searchsorted(own, used), used)
        ids, counts = np.concatenate([ids, -1 - np.array(own)]), np.concatenate([counts, np.ones(len(own), np.int64)])
    size = counts[used]
    begin = starts_of(counts)[:-1][used]
    out = ids[np.repeat(begin - starts_of(size)[:-1], size) + np.arange(int(size.sum()))] if len(used) else ids[:0]
    ends = starts_of(np.array(sizes, np.int64))
    return out, np.diff(starts_of(size)[ends])


def decode_ids(tables: Tables, ids: np.ndarray) -> str:
    """The text of a run of ids."""
    try:
        raw = b"".join([tables.pieces[i] for i in ids.tolist()])
    except (IndexError, TypeError):
        bad = [i for i in ids.tolist() if i >= tables.size or tables.pieces[i] is None]
        raise ValueError(f"ids that the tokenizer does not have: {sorted(set(bad))[:5]}") from None
    return raw.decode("utf-8", "replace")


def _default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(FILE)


def encode(docs: DataFrame, path: str | None = None, text: str = "text", **keep: Column) -> DataFrame:
    """The columns in ``keep``, n_tokens and ``ids`` of every row; the driver reads the file at ``path``."""
    tables = read_tables(path or _default_path())
    src = docs.select(F.col(f"`{text}`").alias("__text"), *[c.alias(n) for n, c in keep.items()])
    schema = T.StructType([*src.schema.fields[1:], T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])
    names = schema.names

    def work(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in stream:
            for a, b, texts in steps(rows.column(0), STEP_BYTES):
                ids, counts = encode_texts(tables, [t.decode() for t in texts])
                raw, at = ids.astype("<u4"), starts_of(counts)
                packed = pa.array([raw[at[i]: at[i + 1]].tobytes() for i in range(len(texts))], pa.binary())
                yield pa.RecordBatch.from_arrays([*rows.slice(a, b - a).columns[1:], pa.array(counts, pa.int64()), packed], names)

    return src.mapInArrow(work, schema)


def decode(encoded: DataFrame, path: str | None = None, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``encoded`` with the text of its column ``ids`` (null: null) in place of that column, as the last column."""
    tables = read_tables(path or _default_path())
    kept = [f for f in encoded.schema.fields if f.name != ids]
    src = encoded.select(F.col(f"`{ids}`"), *[F.col(f"`{f.name}`") for f in kept])
    schema = T.StructType([*kept, T.StructField(decoded, T.StringType())])
    names = schema.names

    def work(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in stream:
            texts = [None if x is None else decode_ids(tables, np.frombuffer(x, "<u4")) for x in rows.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*rows.columns[1:], pa.array(texts, pa.string())], names)

    return src.mapInArrow(work, schema)
