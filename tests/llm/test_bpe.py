"""Operator 11 against the tokenizers library."""

import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
from corpus_rows import ordered
from mercato.llm import bpe, queries
from pyspark.sql import functions as F
from tokenizers import Tokenizer

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path(bpe.FILE)
LIBRARY = Tokenizer.from_file(PATH)
TABLES = bpe.read_tables(PATH)


def library(texts):
    return [x.ids for x in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def ours(texts):
    ids, counts = bpe.encode_texts(TABLES, texts)
    at = np.concatenate([[0], np.cumsum(counts)])
    return [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:], strict=True)]


def hard_texts():
    rng = random.Random(4)
    out = ["", " ", "  ", "\n\n  a  ", "<|endoftext|>", "a<|endoftext|> b <|endoftext|><|endoftext|>", "<|endoftext|", "don't I'll 'S 'd'd we'VE", "x" * 5000,
           "ab" * 3000, "é" * 999, "日本語" * 700, "\x00\x01 \x7f\x1c\x1f", "a\xa0 b 　c", "\r\n\r\n x", "é ‍👩‍🔬", "՘a\U00010940b 1\U0001ccf0"]
    out += ["".join(rng.choice("abcdefghij klmnop\n\t'12é漢🙂²½") for _ in range(rng.randint(1, 300))) for _ in range(200)]
    return out + ["".join(rng.choice(a) for _ in range(8000)) for a in ("etaoinshrdlu", "0123456789", "ACGT", "=-")]


def test_encoding_and_decoding_are_the_librarys():
    texts = hard_texts()
    assert ours(texts) == library(texts)
    assert [bpe.decode_ids(TABLES, np.array(x)) for x in library(texts)] == texts


def test_characters_of_every_kind():
    """Letters, digits, white space and others, next to each other (every 7th code point)."""
    points = [c for c in range(0, 0x110000, 7) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{chr(c)}1{chr(c)}! {chr(c)}{chr(c)}\n" for c in points[i: i + 500]) for i in range(0, len(points), 500)]
    assert ours(texts) == library(texts)


@pytest.mark.parametrize("rounds", [0, 1, 5, 10**6])
def test_both_orders_of_rounds_agree(rounds):
    words = [t.encode() for t in hard_texts() if t]
    ids, counts = bpe.encode_words(TABLES, words, rounds)
    want = bpe.encode_words(TABLES, words)
    assert np.array_equal(ids, want[0]) and np.array_equal(counts, want[1])


def test_any_ids_decode_as_in_the_library():
    rng = random.Random(6)
    for _ in range(200):
        ids = [rng.randrange(TABLES.size) for _ in range(rng.randint(0, 12))]
        assert bpe.decode_ids(TABLES, np.array(ids, np.int64)) == LIBRARY.decode(ids, skip_special_tokens=False)
    with pytest.raises(ValueError, match="does not have"):
        bpe.decode_ids(TABLES, np.array([TABLES.size]))


def test_unsupported_files_are_refused(tmp_path):
    with open(PATH, encoding="utf-8") as f:
        file = json.load(f)
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "Whitespace"}}, {"model": file["model"] | {"dropout": 0.1}},
                   {"model": file["model"] | {"merges": file["model"]["merges"][::-1]}}):
        path = tmp_path / "t.json"
        path.write_text(json.dumps(file | change))
        with pytest.raises(ValueError):
            bpe.read_tables(str(path))


def test_rows(spark, corpus, docs, clashing, no_docs):
    """Nulls, empty and very long texts, repeated rows and ids, clashing columns, no rows."""
    want = ordered((r[0], len(x), np.array(x, "<u4").tobytes(), r[1] or "") for r, x in zip(corpus, library([r[1] or "" for r in corpus]), strict=True))
    for table in (docs, clashing):
        out = bpe.decode(bpe.encode(table, doc_id=F.col("doc_id"), __packed=F.col("doc_id")).withColumn("copy", F.col("ids")))
        assert out.columns == ["doc_id", "__packed", "n_tokens", "copy", "decoded"]
        assert ordered(out.select("doc_id", "n_tokens", "copy", "decoded").collect()) == want
    assert bpe.decode(bpe.encode(no_docs)).collect() == []
    assert bpe.decode(spark.createDataFrame([(None, 1)], "ids binary, n int")).collect() == [(1, None)]


def test_query(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = [(r[0], len(x), hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest(),
             hashlib.sha256(LIBRARY.decode(x, skip_special_tokens=False).encode()).hexdigest()) for r, x in zip(rows, library([r[1] or "" for r in rows]), strict=True)]
    assert ordered(queries.op11_bpe(spark, SF).collect()) == ordered(want)
