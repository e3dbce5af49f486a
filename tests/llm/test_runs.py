"""Operator 13 against a plain search for runs."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from corpus_rows import ordered
from mercato.llm import queries, runs
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def plain_runs(w, least=24):
    n, out = len(w), set()
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if size >= max(least, 3 * q) and not any(all(w[k] == w[k + p] for k in range(i, i + size - p)) for p in range(1, q)):
                out.add((i, size, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def case(rng):
    kind, n = rng.randrange(7), rng.randint(0, 260)
    if kind == 0:
        return [rng.randrange(2) for _ in range(n)]
    if kind == 1:
        return [0] * n
    if kind == 2:
        base = [rng.randrange(3) for _ in range(rng.randint(1, 60))]
        return [rng.randrange(3) for _ in range(rng.randrange(40))] + [base[i % len(base)] for i in range(n)] + [rng.randrange(3) for _ in range(rng.randrange(40))]
    if kind == 3:  # Fibonacci words have as many runs as can be
        a, b = [0], [0, 1]
        while len(b) < n:
            a, b = b, b + a
        return b[:n]
    if kind == 4:
        out = []
        while len(out) < n:
            base = [rng.randrange(4) for _ in range(rng.randint(1, 12))]
            out += base * rng.randint(1, 6)
        return out
    if kind == 5:  # runs within runs
        return ([rng.randrange(2) for _ in range(rng.randint(1, 4))] * rng.randint(3, 12) + [7] * rng.randint(0, 2)) * rng.randint(1, 5)
    return [rng.randrange(500) for _ in range(n)]


def found(docs, least=24):
    return runs.find_in(np.array([x for d in docs for x in d], np.int64), np.array([len(d) for d in docs], np.int64), least)


@pytest.mark.parametrize("least", [1, 3, 9, 24, 30])
def test_all_runs_are_found(least):
    rng = random.Random(least)
    docs = [case(rng) for _ in range(300)]
    assert found(docs, least) == [plain_runs(d, least) for d in docs]


def test_transforms_beyond_the_longest_are_halved(monkeypatch):
    monkeypatch.setattr(runs, "_LONGEST", 64)
    rng = random.Random(12)
    docs = [case(rng) for _ in range(100)]
    assert found(docs) == [plain_runs(d) for d in docs]


def test_transform_is_exact():
    rng = np.random.default_rng(1)
    for size in (2, 8, 64):
        a, b = rng.integers(0, runs.PRIME, (2, 3, size)).astype(np.uint64)
        prime = np.uint64(runs.PRIME)
        got = runs.transform(runs.transform(a) * runs.transform(b) % prime, True) * np.uint64(pow(size, -1, runs.PRIME)) % prime
        want = [[sum(int(a[r, i]) * int(b[r, (j - i) % size]) for i in range(size)) % runs.PRIME for j in range(size)] for r in range(3)]
        assert got.tolist() == want


def test_sums_of_zero_modulo_the_prime_only_are_no_runs():
    """Word numbers that differ by the prime look equal to the transform, not to the comparison."""
    docs = [[0, 1, 2, 3, 4, 5, 6, 7] + [x + runs.PRIME for x in range(8)] + [0, 1, 2, 3, 4, 5, 6, 7]]
    assert found(docs) == [[]]


def test_long_texts():
    rng = random.Random(2)
    base = [rng.randrange(9000) for _ in range(20_000)]
    assert found([base * 3 + [1]])[0] == [(0, 60_000, 20_000)] or base[0] == 1
    assert found([[0] * 50_000]) == [[(0, 50_000, 1)]]
    assert found([[0, 1] * 25_000 + [5] + [0, 1] * 100]) == [[(0, 50_000, 2), (50_001, 200, 2)]]


def digests(rows):
    """The contracted columns, by plain Python."""
    out = []
    for doc_id, text in rows:
        w = (text or "").encode().split()
        h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
        own = plain_runs(w)
        gone = {i for s, n, q in own for i in range(s + q, s + n)}
        best = max(own, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
        milli = None if best[0] is None else 1000 * best[1] // best[2]
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in own)
        out.append((doc_id, len(own), *best, milli, hashlib.sha256(lines.encode()).hexdigest(),
                    hashlib.sha256(b" ".join(x for i, x in enumerate(w) if i not in gone)).hexdigest()))
    return out


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").where("length(text) < 12000").collect()]
    got = [r for r in queries.op13_periodic_runs(spark, SF).collect()]
    want = digests(rows)
    assert {tuple(r) for r in got} >= set(want) and sum(r["n_runs"] > 0 for r in got) > 5
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_rows(corpus, docs, clashing, no_docs):
    """Nulls, empty and very long texts, repeated rows and ids, clashing columns, no rows."""
    short = {r[:2] for r in corpus if len(r[1] or "") < 10_000}
    for table in (docs, clashing):
        out = runs.find_runs(table, doc_id=F.col("doc_id"), text_=F.col("text")).collect()
        assert len(out) == len(corpus)
        for r in out:
            w = (r["text_"] or "").encode().split()
            assert r["n_words"] == len(w)
            if (r["doc_id"], r["text_"]) in short:
                assert [tuple(x) for x in r["runs"]] == plain_runs(w)
    by_id = {r["doc_id"]: r for r in out}
    assert [tuple(x) for x in by_id[93]["runs"]] == [(0, 3000, 1)] and by_id[93]["collapsed"] == "word"
    assert by_id[2]["runs"] == [] and by_id[2]["best"] is None and by_id[2]["collapsed"] == ""
    assert by_id[92]["runs"] == [] and by_id[94]["n_words"] == 1
    assert runs.find_runs(no_docs).collect() == []
    assert ordered((r["doc_id"], r["n_words"]) for r in out) == ordered((r[0], len((r[1] or "").encode().split())) for r in corpus)
