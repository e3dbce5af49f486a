"""Operator 3 on texts of very many matches, and its SQL on a table where terms are found."""

import random
import time

import duckdb
from mercato.llm import disclosure, oracle, queries
from pyspark.sql import functions as F


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def test_texts_of_very_many_matches(spark):
    """Up to 200,000 matches of a pattern in one text; most are no card, or fail the check of the digits."""
    rng = random.Random(1)
    cards = ["".join(rng.choice("0123456789") for _ in range(16)) for _ in range(40_000)]
    phones = [f"+49 30 {i:07d}" for i in range(20_000)]
    many = [  # text, and how many spans of each kind
        (" ".join(f"{rng.randrange(10**6)}," for _ in range(200_000)), [0, 0, 0, 0]),
        (", ".join(cards), [0, 0, sum(map(luhn, cards)), 0]),
        (" ".join(f"user{i}@host{i % 7}.example.org" for i in range(20_000)), [20_000, 0, 0, 0]),
        (", ".join(f"10.{i % 256}.{i % 300}.7" for i in range(30_000)), [0, sum(i % 300 < 256 for i in range(30_000)), 0, 0]),
        ("; ".join(phones), [0, 0, 0, 20_000]),
        ("1" * 300_000, [0, 0, 0, 0]), ("1-2 " * 100_000, [0, 0, 0, 0]), ("12  " * 50_000 + "4111 1111 1111 1111", [0, 0, 1, 0]),
    ]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(many)], "doc_id long, text string").repartition(8)
    began = time.time()
    rows = df.select("doc_id", *[disclosure.base_spans(F.col("text"), k).alias(k) for k in disclosure.KINDS]).collect()
    assert time.time() - began < 120
    for r in rows:
        text, counts = many[r["doc_id"]]
        assert [len(r[k]) for k in disclosure.KINDS] == counts
        assert all(text[x["start"]: x["end"]] == x["value"] for k in disclosure.KINDS for x in r[k])


def test_many_terms_and_spans_of_one_text(spark):
    """Words beside spans, with offsets, in a text of many of both."""
    text = " ".join(f"Zorblax{i % 3} a{i}@b.example.org" for i in range(500))
    rows = [(i, f"{text} {i}") for i in range(4)] + [(50 + i, f"nothing of that kind {i}") for i in range(80)]
    found = disclosure.find_spans(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r["doc_id"]: r for r in found.collect()}
    assert all(got[0]["text"][x["start"]: x["end"]].startswith("Zorblax") for x in got[0]["term"]) and len(got[0]["term"]) == 500
    clean = {r["doc_id"]: r["text"] for r in disclosure.sanitised(found).collect()}
    assert clean[0].split() == ["<email>"] * 500 + ["0"] and clean[50] == "nothing of that kind 0"


def test_overlapping_spans_leave_nothing(spark):
    """Addresses within a phone number and within the host of an e-mail address."""
    rows = [(1, "call +49.30.12.34 now"), (2, "x@8.8.8.8 y"), (3, "a@b.co 1.2.3.4")]
    out = {r["doc_id"]: r["text"] for r in disclosure.sanitised(disclosure.find_spans(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert out == {1: "call <phone> now", 2: "<email> y", 3: "<email> <ip>"}


def test_sql_gives_the_same_on_a_table_with_terms(spark, tmp_path, corpus):
    body = ["alpha", "beta", "gamma", "delta"]
    rows = [(i, f"{w} thanks\nCase-4711 user_77\nZorblax\nmail jane.doe@corp.example.org now {w}") for i, w in enumerate(body)]
    rows += [(10 + i, f"{w} call +49 30 1234567 or 30") for i, w in enumerate(body)]
    rows += [(20, "\n".join(["other words"] * 40 + ["Zorblax"])), (21, "\n".join(f"line {i} of server7 at 10.0.0.1" for i in range(100)))]
    rows += [(100 + i, f"thanks mail now call or plain {i}") for i in range(60)] + [(None, "Zorblax (zorblax)"), (None, None), (7, "")]
    rows += [(r[0], r[1]) for r in corpus if len(r[1] or "") < 5_000]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(r) for r in queries.op3_pii(spark, str(tmp_path)).collect()]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = con.execute(oracle.oracle_sql()["op3_pii"]).fetchall()
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert sum("term:" in r[6] for r in got) >= 9
