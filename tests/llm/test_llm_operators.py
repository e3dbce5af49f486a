"""Each operator against brute force, on rows with nulls, empty, long, equal and repeated texts."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import brute
from corpus_rows import ordered
from mercato.llm import (curriculum, decontaminate, disclosure, host_rules, jaccard_join, licenses, line_templates,
                         pitman_yor, tables, warc_store, window_dedup)
from mercato.session import scratch_path


def texts(corpus):
    return [(r[0], r[1]) for r in corpus]


# 1 line dedup


def test_line_templates_match_brute_force(clashing, corpus):
    out = line_templates.drop_recurring(clashing)
    assert out.columns == [*clashing.columns, "line_dedup"]
    got = out.select("doc_id", "text").collect()
    assert ordered(got) == ordered(brute.dropped_lines(texts(corpus)))
    assert any(a != b for a, b in zip(ordered(got), ordered(texts(corpus))))


def test_line_templates_variable_fields(spark):
    rows = [(1, "Posted on 2024-01-02 by the user anna in category news today\nown line of words here one"),
            (2, "Posted on 2023-05-06 by the user boris in category news today\nother words stay in this line"),
            (3, "Posted on 1999-09-09 by the user anna in category news today"),
            (4, "1 2 3 4 5 6"), (5, "7 8 9 10 11 12"), (6, "Les."), (7, "Les.")]
    got = {r["doc_id"]: r for r in line_templates.drop_recurring(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1]["text"] == rows[0][1]
    assert got[2]["text"] == "other words stay in this line"
    assert got[3]["text"] == "" and got[3]["line_dedup"]["n_dropped"] == 1
    assert [got[i]["text"] for i in (4, 5, 6, 7)] == [r[1] for r in rows[3:]]


def test_line_templates_learn_fields(spark, corpus):
    names = ["anna", "boris", "carla", "dmitri", "emma", "farid"]
    towns = ["Rome", "Oslo", "Lima", "Bonn", "Kyiv", "Cork"]
    own = ["", "Good morning", "it was cold", "the hen sat on eggs", "we left", "three men went home at last"]
    rows = [(1000 + i, f"All rights reserved\nPosted by {n} in News\n{x}\nThe user {n} has logged in today from {t} again")
            for i, (n, t, x) in enumerate(zip(names, towns, own))]
    many = [(1100 + i, f"Posted by {n} in News") for i, n in enumerate(["anna"] * 9 + names)]  # a frequent name is a field all the same
    mixed = [(1200 + i, f"Posted by {a} {b} {c}") for i, (a, b, c) in enumerate(zip(names, towns[::-1], own[3].split() + ["end"]))]
    texts_ = [*rows, *many, *mixed, *rows[:2], *texts(corpus)]
    docs = spark.createDataFrame(texts_, "doc_id long, text string").repartition(5)
    got = [(r[0], r[1]) for r in line_templates.drop_recurring(docs).select("doc_id", "text").collect()]
    assert ordered(got) == ordered(brute.dropped_lines(texts_))
    held = dict(got)
    assert held[1000] == rows[0][1] and [held[1000 + i] for i in range(1, 6)] == own[1:]
    assert all(held[i] == "" for i, _ in many) and all(held[i] == x for i, x in mixed)


def test_line_templates_empty(no_docs):
    assert line_templates.drop_recurring(no_docs).count() == 0


# 2 substring dedup


def test_window_dedup_matches_brute_force(clashing, corpus):
    out = window_dedup.remove_repeats(clashing, doc_id=F.col("doc_id"))
    got = out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256)).collect()
    want = brute.cut_windows(texts(corpus), 35)
    assert ordered(got) == ordered(want)
    assert sum(r[2] for r in want) > 3000
    spans = [x for r in out.select("removed").collect() for x in zip(r[0], r[0][1:])]
    assert all(a["end"] < b["start"] for a, b in spans)  # maximal


def test_window_dedup_empty(no_docs):
    assert window_dedup.remove_repeats(no_docs, doc_id=F.col("doc_id")).count() == 0


def test_window_hash_marks_only_equal_windows():
    rng = np.random.default_rng(1)
    texts_ = [b" ".join(b"%d" % x for x in rng.integers(0, 3, 400)) for _ in range(20)]
    _, start, one, two = window_dedup.window_hashes(texts_, 6)
    flat = [w for t in texts_ for w in t.split()]
    by_hash = {}
    for s, a, b in zip(start.tolist(), one.tolist(), two.tolist()):
        by_hash.setdefault((a, b), set()).add(tuple(flat[s:s + 6]))
    assert all(len(x) == 1 for x in by_hash.values())
    assert len(by_hash) == len(set().union(*by_hash.values()))


# 3 personal data


def test_base_spans_match_brute_force(spark, clashing, corpus):
    found = disclosure.find_spans(clashing).select("doc_id", *disclosure.KINDS).collect()
    got = Counter((r["doc_id"], tuple((k, x["start"], x["end"]) for k in disclosure.KINDS for x in r[k])) for r in found)
    assert got == Counter((d, tuple(brute.base_spans(t))) for d, t in texts(corpus))


def test_base_spans_hard_texts(spark):
    hard = ["a@b.c_d@e.f x@y", "1.2.3.4.5.6.7.8 999.1.2.3.4 01.002.255.256", "4111 1111 1111 1111 and 4111-1111-1111-1112 41111111111111111111",
            "+1 (555) 123-4567. +49 30", "é😀 q@r.st 😀 8.8.8.8", "4 " * 30_000, "a@" + "b." * 30_000, "9." * 30_000, "+1" + " (" * 30_000, "u.v-w@x" * 5]
    df = spark.createDataFrame(list(enumerate(hard)), "doc_id long, text string")
    got = {r["doc_id"]: [(k, x["start"], x["end"]) for k in disclosure.KINDS for x in r[k]] for r in disclosure.find_spans(df).collect()}
    assert got == {i: brute.base_spans(t) for i, t in enumerate(hard)}


def test_disclosing_terms_are_removed(spark):
    rows = [(i, f"the secret zorblax met jane.doe@corp.example.org {'abcdefgh'[i]} {i} the") for i in range(5)]
    rows += [(100 + i, f"the plain line {i} of words") for i in range(50)]
    rows += [(200 + i, "copied line has hapax john@x.example.org") for i in range(9)]  # one distinct line
    spans = disclosure.find_spans(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r["doc_id"]: r for r in disclosure.sanitised(spans).collect()}
    assert [x["value"] for x in got[0]["term"]] == ["", "", ""]
    assert got[0]["text"] == "the    <email> a 0 the"
    assert got[100]["text"] == rows[5][1]
    assert got[200]["text"] == "copied line has hapax <email>"
    none = spark.createDataFrame([], "doc_id long, text string")
    assert disclosure.find_spans(none).count() == 0


def test_disclosing_terms_with_digits_and_on_other_lines(spark):
    body = ["alpha", "beta", "gamma", "delta"]
    rows = [(i, f"{w} thanks\nCase-4711 user_77\nZorblax\nmail jane.doe@corp.example.org now {w}") for i, w in enumerate(body)]
    rows += [(10 + i, f"{w} call +49 30 1234567 or 30") for i, w in enumerate(body)]
    rows += [(20, "\n".join(["other words"] * 40 + ["Zorblax"]))] + [(100 + i, f"thanks mail now call or plain {i}") for i in range(60)]
    spans = disclosure.find_spans(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r["doc_id"]: r["text"] for r in disclosure.sanitised(spans).collect()}
    assert got[0] == "alpha thanks\n \n\nmail <email> now alpha"
    assert got[10] == "alpha call <phone> or " and got[20].endswith("words\n") and got[100] == rows[-60][1]


# 4 archive


def _parse(record):
    head, _, rest = bytes(record).partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    assert lines[0] == "WARC/1.1"
    fields = dict(x.split(": ", 1) for x in lines[1:])
    n = int(fields["Content-Length"])
    assert rest[n:] == b"\r\n\r\n"
    return fields, rest[:n].partition(b"\r\n\r\n")[2]


def test_archive_round_trip(spark):
    big = "<html>" + "é" * 60
    rows = [(1, "http://a/", big), (2, "http://b/", big), (3, None, "x"), (4, "u\r\nEvil: 1", "x"), (5, "e", None), (6, "e", ""),
            (7, "h", "y" * 300_000), (8, "z", big), (0, "r", "rep" * 40), (0, "r", "rep" * 40), (None, "n", big)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit("clash"))
    path = scratch_path(spark, "warc-test")
    warc_store.write_archive(pages, path)
    got = warc_store.read_archive(spark, path).collect()
    assert len(got) == len(rows)
    assert spark.read.parquet(f"{path}/payloads").count() == 5
    by_id = {r["page_id"]: r for r in got}
    ids = {}
    for r in got:
        fields, body = _parse(r["record"])
        ids.setdefault(fields["WARC-Record-ID"], r)
        assert fields["WARC-Type"] == r["record_type"]
        assert body == (b"" if r["record_type"] == "revisit" else bytes(r["payload"]))
    assert len(ids) == len(rows)
    for r in got:
        if r["record_type"] == "revisit":
            assert ids[_parse(r["record"])[0]["WARC-Refers-To"]]["page_id"] == r["refers_to"]
    assert [by_id[i]["refers_to"] for i in (1, 2, 3, 4, 8, None)] == [None, 1, None, None, 1, 1]
    assert sorted(r["record_type"] for r in got if r["page_id"] == 0) == ["response", "revisit"]
    assert all(bytes(by_id[r[0]]["payload"]) == (r[2] or "").encode() for r in rows)
    assert "Evil" not in _parse(by_id[4]["record"])[0]


def test_archive_empty_and_damaged(spark):
    path = scratch_path(spark, "warc-empty")
    warc_store.write_archive(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc_store.read_archive(spark, path).count() == 0
    path = scratch_path(spark, "warc-bad")
    warc_store.write_archive(spark.createDataFrame([(1, "u", "hello")], "page_id long, url string, html string"), path)
    bad = spark.read.parquet(f"{path}/payloads").withColumn("payload_digest", F.lit("0" * 64))
    spark.read.parquet(f"{path}/records").withColumn("payload_digest", F.lit("0" * 64)).write.parquet(f"{path}-b/records")
    bad.write.parquet(f"{path}-b/payloads")
    with pytest.raises(Exception, match="does not match"):
        warc_store.read_archive(spark, f"{path}-b").collect()


# 5 decontamination


@pytest.fixture(scope="module")
def leaky(spark, corpus):
    rng = np.random.default_rng(4)
    item = [" ".join("q%d" % x for x in rng.integers(0, 40, n)) for n in (12, 12, 30, 45, 3, 45)]
    near = item[3].split()
    near[0] = "swapped"
    far = item[5].split()
    far[20] = far[30] = far[10] = "swapped"
    extra = [(200, "before " + item[0] + " after", "en", "s1", 1), (201, item[2].upper() + ".", "en", "s1", 1), (202, "a b " + " ".join(near), "en", "s1", 1),
             (203, " ".join(far), "en", "s1", 1), (204, " ".join(item[3].split()[:40]), "en", "s1", 1), (205, "z " + item[4] + " z", "en", "s1", 1),
             (206, f"{item[0]} {item[1]} {item[0]}", "en", "s1", 1)]
    return [*enumerate(item), (90, None), (91, ""), (92, item[0])], extra


@pytest.mark.parametrize("block_items", [2000, 3])
def test_decontamination_matches_brute_force(spark, clashing, corpus, leaky, block_items):
    items, extra = leaky
    more = spark.createDataFrame(extra, clashing.select("doc_id", "text", "lang", "source", "n_chars").schema)
    docs = clashing.unionByName(more, allowMissingColumns=True)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.find_matches(docs, benchmark, block_items=block_items).collect()
    want = brute.benchmark_matches(texts([*corpus, *extra]), items)
    assert ordered(got) == ordered(want)
    assert {r[0] for r in want} == {200, 201, 202, 204, 205, 206}
    kept = decontaminate.drop_contaminated(docs, benchmark, block_items=block_items)
    assert kept.columns == docs.columns
    assert kept.count() == len(corpus) + 1


def test_decontamination_empty(spark, docs, no_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_matches(docs, none).count() == 0
    assert decontaminate.drop_contaminated(no_docs, none).count() == 0


def test_fingerprints_follow_the_definition():
    rng = np.random.default_rng(2)
    shingles = rng.integers(0, 1 << 62, 500).astype(np.uint64)
    start = np.sort(rng.choice(450, 60, replace=False))
    end = start + rng.integers(1, 40, 60)
    got = decontaminate.fingerprints(shingles, start, end)
    signs = decontaminate._signs(shingles).astype(int)
    for s, e, g in zip(start, end, got):
        assert (np.unpackbits(g) == (signs[s:e].sum(0) > 0)).all()


# 6 language model


def test_unigram_base_and_score(docs, corpus):
    got = ordered(pitman_yor.scores(docs).collect())
    want = ordered(brute.unigram_scores(texts(corpus)))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert all(math.isclose(a[5], b[5], rel_tol=1e-9) for a, b in zip(got, want))
    assert all(r[6] < 0 for r in got)


def test_probabilities_sum_to_one_after_sweeps():
    rng = np.random.default_rng(0)
    n_words = 30
    key = np.unique(rng.integers(0, n_words, 400) * 65536 + rng.choice([0, 1, 256, 257, 770], 400))
    key = np.union1d(key, np.arange(n_words) * 65536)
    part = pitman_yor._Part([b"w%02d" % i for i in range(n_words)], key, rng.integers(1, 900, len(key)))
    prior = pitman_yor.Prior()

    def totals(own, parent):
        return pitman_yor._Totals(np.bincount(part.context, part.count, 65536), np.bincount(part.context, own, 65536),
                                  np.bincount(part.parent_context, parent, 256), n_words)

    own, parent = np.ones(len(key)), np.ones(len(part.parent_keys))
    for s in range(3):
        own, parent = pitman_yor._sweep(part, own if s else None, parent if s else None, totals(own, parent), prior, rng)
        assert (own >= 1).all() and (own <= part.count).all()
    x = totals(own, parent)
    root = np.bincount(part.parent_word, parent, n_words)
    in_parent = np.bincount(part.parent, own, len(part.parent_keys))
    for context in (0, 257, 770, 5000):
        total = pitman_yor._predict(x, prior, np.zeros(1), (np.zeros(1), np.zeros(1)), np.array([context // 256]), (np.zeros(1), np.zeros(1)), np.array([context]))[0]
        for w in range(n_words):
            i, j = np.flatnonzero(key == w * 65536 + context), np.flatnonzero(part.parent_keys == w * 256 + context // 256)
            up = (in_parent[j], parent[j]) if len(j) else (np.zeros(1), np.zeros(1))
            at = (part.count[i], own[i]) if len(i) else (np.zeros(1), np.zeros(1))
            total += pitman_yor._predict(x, prior, root[[w]], up, np.array([context // 256]), at, np.array([context]))[0]
        assert math.isclose(total, 1, rel_tol=1e-9)


def test_seating_means():
    """Seated one after another: the mean number of tables agrees between the exact and the run-wise part."""
    rng = np.random.default_rng(5)
    got = pitman_yor.seat(np.full(4000, 600), np.full(4000, 3.0), 0.5, rng).mean()
    t = np.ones(4000)
    for i in range(1, 600):
        t += rng.random(4000) < 3.0 / (i - 0.5 * t + 3.0)
    assert abs(got - t.mean()) < 0.05 * t.mean()


def test_model_beats_unigrams_on_held_out_text(spark):
    rng = np.random.default_rng(8)
    rows = []
    for i in range(300):
        a, b = ("ka", "mu") if i % 2 else ("le", "so")
        rows.append((i, " ".join(f"{a if j % 2 else b}{int(rng.integers(0, 30))}{'xy'[i % 2]}" for j in range(60))))
    got = pitman_yor.scores(spark.createDataFrame(rows, "doc_id long, text string")).where("held_out").collect()
    assert sum(r["score"] for r in got) > 0.95 * sum(r["base_score"] for r in got)


def bigrams_once(rng, n_words=40, n_texts=24):
    """Texts without a bigram that occurs twice in training, whose words all end alike; and held-out ones, some words unknown."""
    vocab = [f"{i}zz" for i in range(n_words)]
    unused, rows, i = {(a, b) for a in vocab for b in vocab}, [], 0
    first, last = rng.permutation(vocab)[:n_texts].tolist(), rng.permutation(vocab)[:n_texts].tolist()
    while first:
        if zlib.crc32(str(i).encode()) % 7 == 2:
            rows.append((i, " ".join(rng.choice([*vocab, "newzz", "New"], 12).tolist())))
        else:
            text, end = [first.pop()], last.pop()
            while len(text) < 9 or (text[-1], end) not in unused:
                text.append(str(rng.choice([w for w in vocab if (text[-1], w) in unused])))
                unused.discard((text[-2], text[-1]))
            unused.discard((text[-1], end))
            rows.append((i, " ".join([*text, end])))
        i += 1
    return rows


@pytest.mark.parametrize("split_at", [1 << 20, 2])
def test_contexts_are_whole_words(spark, split_at):
    rows = bigrams_once(np.random.default_rng(12))
    got = pitman_yor.scores(spark.createDataFrame(rows, "doc_id long, text string"), split_at=split_at).select("doc_id", "score").collect()
    for a, b in zip(ordered(got), ordered(brute.one_table_scores(rows)), strict=True):
        assert a[0] == b[0] and math.isclose(a[1], b[1], rel_tol=1e-9)


def test_splitting_frequent_words_keeps_the_model(docs):
    one, two = [ordered(pitman_yor.scores(docs, split_at=k).collect()) for k in (1 << 20, 50)]
    assert [r[:6] for r in one] == [r[:6] for r in two]
    assert math.isclose(sum(r[6] for r in one), sum(r[6] for r in two), rel_tol=0.01)


def test_model_tables_have_small_row_groups(spark):
    """A writer or reader holds a row group as a whole, and a row is a whole batch or shard."""
    files = tables.settled(spark.range(1000), "row_groups", 8).inputFiles()
    metas = [pq.ParquetFile(f.removeprefix("file:")).metadata for f in files]
    rows = [m.row_group(i).num_rows for m in metas for i in range(m.num_row_groups)]
    assert sum(rows) == 1000 and max(rows) <= 8


def test_questions_are_sorted_by_number():
    """Numbers come in any order; the trigrams that a batch asks for are sorted by them, so look-ups run in sequence."""
    token, uniq, _, lens = pitman_yor._tokens([b"b a c b a d", b"c a b", b""])
    ids = np.array([50, 7, 31, 90, 2][: len(uniq)], "<u8")
    by_number = pitman_yor._by_number(token, ids, ids + 1)
    assert by_number[1].tolist() == sorted(ids.tolist()) and by_number[1][by_number[0]].tolist() == ids[token].tolist()
    assert by_number[2].tolist() == (by_number[1] + 1).tolist()
    token, ids, count = by_number
    batch = pitman_yor._Batch(pitman_yor._pack(token.astype("<u4"), lens.astype("<u4"), ids, count), 4, 1 << 20)
    grams = list(zip(batch.b[batch.pair].tolist(), batch.w[batch.pair].tolist(), batch.a.tolist()))
    assert grams == sorted(grams) and len(set(grams)) == len(grams)


def test_single_customers_are_not_drawn_for():
    """One customer takes one table, and the others' seats do not depend on how many there are of these."""
    few, many = np.array([3, 300, 2]), np.array([1, 3, 1, 300, 2, 1])
    a = pitman_yor.seat(few, np.full(3, 2.0), 0.5, np.random.default_rng(4))
    b = pitman_yor.seat(many, np.full(6, 2.0), 0.5, np.random.default_rng(4))
    assert b[[0, 2, 5]].tolist() == [1, 1, 1] and b[[1, 3, 4]].tolist() == a.tolist()


def test_model_empty(no_docs):
    assert pitman_yor.scores(no_docs).count() == 0


# 7 mixing


def test_mixing_targets_and_takes(clashing, corpus):
    got = curriculum.plan(clashing)
    rows = got.collect()
    assert len(rows) == len(corpus)
    sizes = Counter()
    for r in corpus:
        sizes[r[3]] += len(brute.words(r[1]))
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, left = {}, 1.5 * sum(sizes.values())
    while True:  # share again until no source is above its cap
        free = [s for s in names if s not in target]
        share = {s: (left - sum(target.values())) * weight[s] / sum(weight[x] for x in free) for s in free}
        full = [s for s in free if share[s] >= 2 * sizes[s]]
        if not full:
            target |= share
            break
        target |= {s: 2 * sizes[s] for s in full}
    taken = Counter()
    for r in rows:
        assert math.isclose(r["target"], target[r["source"]], rel_tol=1e-9, abs_tol=1e-9)
        assert r["source_size"] == sizes[r["source"]] and r["taken"] in (0, r["size"], 2 * r["size"])
        assert len(r["positions"]) * r["size"] == r["taken"] and all(0 <= x <= 1 for x in r["positions"])
        taken[r["source"]] += r["taken"]
    largest = {s: max(len(brute.words(r[1])) for r in corpus if r[3] == s) for s in names}
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1e-6 for s in names)
    again = curriculum.plan(clashing.repartition(5)).collect()
    assert Counter((r["doc_id"], r["size"], r["taken"], tuple(r["positions"])) for r in rows) == \
        Counter((r["doc_id"], r["size"], r["taken"], tuple(r["positions"])) for r in again)
    order = [r["position"] for r in curriculum.training_order(got).collect()]
    assert order == sorted(order) and len(order) == sum(len(r["positions"]) for r in rows)


def test_inverse_demand_inverts_the_integral(spark):
    knots = ((0.0, 0.0), (0.3, 2.0), (0.5, 2.0), (1.0, 0.2))
    t = np.linspace(0, 1, 201)
    w = np.interp(t, *zip(*knots))
    area = np.concatenate([[0], np.cumsum((w[1:] + w[:-1]) / 2 * np.diff(t))])
    df = spark.createDataFrame([(float(x), float(a / area[-1])) for x, a in zip(t, area)], "t double, share double")
    for r in df.select("t", curriculum.inverse_demand(F.col("share"), knots).alias("got")).collect():
        assert abs(r["t"] - r["got"]) < 1e-6


def test_mixing_empty(no_docs):
    assert curriculum.training_order(curriculum.plan(no_docs)).count() == 0


# 8 licenses


def test_licenses_own_and_inherited(spark):
    apache = "Licensed under the Apache License, Version 2.0."
    rows = [("a/LICENSE", apache), ("a/b/code", "int main words here"), ("a/b/c/code", "more words\n// released under the MIT license\nint x"),
            ("a/d/COPYING", "SPDX-License-Identifier: MPL\nThis Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
            ("a/d/e/f", "words"), ("z", None), (None, "text"), ("a/b/code", "int main words here"), ("q/r", "permission to use the words of the day")]
    files = spark.createDataFrame(rows, "path string, text string").withColumn("license", F.lit("clash"))
    got = Counter((r["path"], r["license"], r["how"], r["inherited_from"]) for r in licenses.scan(files, F.col("path"), F.col("text")).collect())
    assert got == Counter([
        ("a/LICENSE", "Apache-2.0", "own", None), ("a/b/code", "Apache-2.0", "inherited", "a"), ("a/b/code", "Apache-2.0", "inherited", "a"),
        ("a/b/c/code", "MIT", "own", None), ("a/d/COPYING", "MPL-2.0", "own", None), ("a/d/e/f", "MPL-2.0", "inherited", "a/d"),
        ("z", None, None, None), ("", None, None, None), ("q/r", None, None, None)])


def test_spdx_headers_name_their_license(spark):
    tag = "SPDX-License-Identifier"
    listed = sorted({spdx for spdx, _ in licenses.TEMPLATES})
    rows = [(f"{spdx}/f", f"// {tag}: {spdx}\nint main words here", spdx) for spdx in listed]
    rows += [("or-later/f", f"# {tag}: GPL-3.0-or-later\nwords", "GPL-3.0"), ("only/f", f"/* {tag}: LGPL-3.0-only */ words", "LGPL-3.0"),
             ("plus/f", f"{tag}:agpl-3.0+. More words", "AGPL-3.0"), ("either/f", f"<!-- {tag}: (ISC OR Apache-2.0) AND MIT -->", "Apache-2.0"),
             ("other/f", f"# {tag}: ISC\nint x", None), ("prose/f", f"an {tag}", None), ("open/f", f"{tag}: \nint x", None),
             ("both/f", f"# {tag}: ISC\n// released under the MIT license\nint x", "MIT"), ("long/f", f"{tag}: " + "a-" * 50_000, None)]
    files = spark.createDataFrame([r[:2] for r in rows], "path string, text string")
    got = {r["path"]: r["license"] for r in licenses.scan(files, F.col("path"), F.col("text")).collect()}
    assert got == {r[0]: r[2] for r in rows}


def test_licenses_on_odd_rows(clashing, corpus, no_docs):
    assert licenses.scan(clashing, F.col("source"), F.col("text")).count() == len(corpus)
    assert licenses.scan(no_docs, F.col("source"), F.col("text")).count() == 0


# 9 Jaccard join


@pytest.mark.parametrize("block", [128, 4])
def test_jaccard_join_matches_brute_force(clashing, corpus, block):
    got = jaccard_join.near_duplicates(clashing, block=block).select("doc_id", "n_shingles", "component_id").collect()
    want = brute.jaccard_components(texts(corpus))
    assert ordered(got) == ordered(want)
    assert len({r[2] for r in want if r[0] and 60 <= r[0] < 90}) < 20


def test_jaccard_join_empty(no_docs):
    assert jaccard_join.near_duplicates(no_docs).count() == 0


@pytest.mark.parametrize("pct", [80, 90])
def test_linked_sets_share_a_prefix(spark, pct):
    rng = np.random.default_rng(6)
    sets = []
    for n in [*range(1, 30), 100, 333]:
        base = rng.integers(0, 1 << 60, n)
        for _ in range(6):
            drop, add = rng.integers(0, n // 8 + 2), rng.integers(0, n // 8 + 2)
            sets.append(set(rng.choice(base, max(n - drop, 1), replace=False).tolist()) | set(rng.integers(0, 1 << 60, add).tolist()))
    sets = [set(x) for x in {frozenset(s) for s in sets}]
    members = spark.createDataFrame([(i, len(s), sorted(s)) for i, s in enumerate(sets)], "class long, n long, shingles array<long>")
    frequent = members.selectExpr("explode(shingles) as __shingle").groupBy("__shingle").agg(F.count("*").alias("df")).where("df > 1")
    ranked = {r["class"]: r for r in jaccard_join.ranked_sets(members, frequent, pct).collect()}
    linked = 0
    for i, a in enumerate(sets):
        for j in range(i):
            b, common = sets[j], len(a & sets[j])
            if common * 100 >= pct * (len(a) + len(b) - common):
                linked += 1
                assert set(ranked[i]["prefix"]) & set(ranked[j]["prefix"])
                assert ranked[min((len(a), i), (len(b), j))[1]]["rich"]
    assert linked > 10 and any(not r["rich"] for r in ranked.values())


@pytest.mark.parametrize("block", [128, 8])
def test_jaccard_join_chains_and_boilerplate(spark, block):
    """Chains of near copies (only neighbours are linked), documents that share 85 percent but are not linked, and
    two originals with copies of their own that share most words: at 5 words / 0.8, over several blocks."""
    rows, rest = [], " ".join(f"b{i}" for i in range(170))
    for i in range(30):
        rows.append((1000 + i, rest + " " + " ".join(f"own{i}x{j}" for j in range(30))))
    for i in range(40):
        rows.append((2000 + i, " ".join(f"c{j}" for j in range(6 * i, 6 * i + 100))))
    for i in range(40):
        words = [f"d{j}" for j in range(100)] + [f"e{i % 2}x{j}" for j in range(60)]
        rows.append((3000 + i, " ".join(words + [f"tail{i}"])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4).persist()
    got = jaccard_join.near_duplicates(docs, k=5, pct=80, block=block).select("doc_id", "n_shingles", "component_id").collect()
    want = brute.jaccard_components(rows, 5, 80)
    assert ordered(got) == ordered(want)
    assert len({r[2] for r in want}) == 33
    docs.unpersist()


def test_t_occurrence_finds_what_pairs_do():
    rng = np.random.default_rng(7)
    base = np.unique(rng.integers(0, 1 << 60, 200).astype(np.uint64))
    sets = [np.sort(np.concatenate([rng.choice(base, 200 - int(k), replace=False), rng.integers(1 << 61, 1 << 62, int(k)).astype(np.uint64)])) for k in rng.integers(0, 14, 40)]
    top = list(range(40))
    for i, j in jaccard_join.t_occurrence(sets, list(range(40)), 90):
        top = [top[j] if x == top[i] else x for x in top]
    want = list(range(40))
    for i in range(40):
        for j in range(i):
            c = len(np.intersect1d(sets[i], sets[j]))
            if c * 100 >= 90 * (len(sets[i]) + len(sets[j]) - c):
                want = [want[j] if x == want[i] else x for x in want]
    assert {frozenset(i for i in range(40) if top[i] == x) for x in top} == {frozenset(i for i in range(40) if want[i] == x) for x in want}


# 10 quality rules


def test_quality_host_verdicts(spark):
    clean = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(80))
    odd = clean + " #" * 12
    rows = [(i, odd, "bad") for i in range(40)] + [(100 + i, clean, "bad") for i in range(5)]
    rows += [(200, odd, "good")] + [(300 + i, clean, "good") for i in range(60)] + [(400, "# " * 300 + clean, "good"), (401, "same words again " * 40, "good")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = {r["doc_id"] for r in host_rules.filter_documents(df).collect()}
    assert kept == {200, *range(100, 105), *range(300, 360)}


def test_quality_keeps_columns_and_handles_odd_rows(clashing, no_docs, corpus):
    out = host_rules.filter_documents(clashing)
    assert out.columns == clashing.columns
    assert all(r["text"] is not None and len(brute.words(r["text"])) >= 50 for r in out.collect())
    assert host_rules.filter_documents(no_docs).count() == 0
    measured = host_rules.measure(clashing, doc_id=F.col("doc_id"), host=F.col("source"))
    assert host_rules.judge(measured).count() == len(corpus)


# words


def test_hashed_words_cut_and_tell_words_apart():
    from mercato.llm.words import hashed_words

    texts_ = [b"", b" a  b\tc\x0b\x0cd\r\ne ", "é x \x1cy\x85 ".encode(), b"a", b"   ", b"ab ba aab aba", b"x" * 5000]
    value, start, end, lens, joined = hashed_words(texts_)
    words = [joined[a:b] for a, b in zip(start, end)]
    assert words == [w for t in texts_ for w in t.split()]
    assert lens.tolist() == [len(t.split()) for t in texts_]
    assert len(set(value.tolist())) == len(set(words))
    rng = np.random.default_rng(9)
    many = [bytes(x) for x in rng.integers(97, 100, (3000, 9)).astype(np.uint8)] + [bytes(x) for x in rng.integers(33, 127, (3000, 3)).astype(np.uint8)]
    value = hashed_words([b" ".join(many)])[0]
    assert len(set(value.tolist())) == len(set(many))
    assert hashed_words([])[0].size == 0
    long = b" ".join([b"word"] * 1_000_000 + [b"y" * 3_000_000, b"word", b"end"])
    value = hashed_words([long])[0]
    assert len(value) == 1_000_003 and len(set(value.tolist())) == 3 and value[0] == value[-2] == hashed_words([b"word"])[0][0]
