"""The registered corpus queries against their SQL, and the pipeline stage by stage against brute force."""

import os
import sys
from collections import Counter

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))

import brute  # noqa: E402
import corpus_pipeline  # noqa: E402
from corpus_rows import ordered  # noqa: E402
from mercato.llm import oracle, queries  # noqa: E402
from oracle_check import check, duck  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_matches_oracle(spark, name):
    res = check(spark, duck(SF), name, queries.queries()[name], oracle.oracle_sql()[name], SF)
    assert res["status"] == "ok", res


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))


def _measures(text):
    w = brute.words(text)
    grams = Counter(zip(w, w[1:], w[2:]))
    hit = {j for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if brute.words(x)]
    return len(w), len(hit), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines), len(lines) - len(set(lines)), sum(len(x.decode()) for x in w)


def test_pipeline_stages(spark, corpus, tmp_path):
    """Each stage on what its predecessor kept."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    quality, line_dedup, near, decontaminate, mixing = [f for _, f in corpus_pipeline.STAGES]
    items = [(1, " ".join(corpus[17][1].split()[5:45])), (2, "nothing of this sort is in any of the texts here")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame(corpus, schema)

    kept = [tuple(r) for r in quality(spark, docs, str(tmp_path)).collect()]
    want = []
    for r in corpus:
        n, rep, symbols, lines, dup, chars = _measures(r[1])
        mild = symbols * 10 > n or dup * 10 > lines * 3 or chars < 3 * n or chars > 10 * n
        if n >= 50 and rep * 2 <= n and not mild:
            want.append(r)
    assert ordered(kept) == ordered(want) and len(want) > 40

    docs = spark.createDataFrame(kept, schema)
    lines = [tuple(r) for r in line_dedup(spark, docs, str(tmp_path)).collect()]
    cut = brute.dropped_lines([(r[0], r[1]) for r in kept])
    assert ordered((r[0], r[1]) for r in lines) == ordered(cut)
    assert all(r[4] == len(r[1]) for r in lines) and len(lines) == len(kept)

    words = [f"w{i * 7919 % 1000}" for i in range(200)]
    near_copy = [w if i not in (20, 70, 120, 170) else "changed" for i, w in enumerate(words)]  # 176 of 216 shingles of five words: 0.815
    far_copy = [w if i not in (20, 60, 100, 140, 180) else "changed" for i, w in enumerate(words)]  # 171 of 221: 0.774
    planted = [(600, " ".join(words), "en", "s1", 1), (601, " ".join(near_copy), "en", "s1", 1), (602, " ".join(far_copy[::-1] + ["x"]), "en", "s1", 1),
               (603, " ".join(words[::-1]), "en", "s1", 1), (604, " ".join([*words, *[f"more{i}" for i in range(48)]]), "en", "s2", 1)]  # 196 of 244: 0.803
    more = [*kept, *planted, (500, kept[0][1], "en", "s9", 1), (None, kept[1][1], "en", "s9", 1), kept[2], (501, "", "en", "s9", 0), (501, "", "en", "s9", 0)]
    left = [tuple(r) for r in near(spark, spark.createDataFrame(more, schema), str(tmp_path)).collect()]
    label = {}
    for r, (_, n, c) in zip(more, brute.jaccard_components([(r[0], r[1]) for r in more], 5, 80)):
        label[r] = ("own", r[1]) if c is None else c if n else r
    assert {label[r] for r in left} == {label[r] for r in more}
    assert {r[0] for r in left} & set(range(600, 605)) == {600, 602, 603}
    words = [r for r in left if brute.words(r[1])]
    assert len(words) == len({label[r] for r in words})
    assert all(label[r] == r[0] for r in words if r[0] is not None)
    assert Counter(r for r in left if not r[1]) == Counter(r for r in more if not r[1])

    clean = [tuple(r) for r in decontaminate(spark, spark.createDataFrame(left, schema), str(tmp_path)).collect()]
    found = {d for d, *_ in brute.benchmark_matches([(i, r[1]) for i, r in enumerate(left)], items)}
    assert ordered(clean) == ordered(r for i, r in enumerate(left) if i not in found) and found

    out = mixing(spark, spark.createDataFrame(clean, schema), str(tmp_path)).collect()
    assert [r["position"] for r in out] == sorted(r["position"] for r in out)
    taken = sum(r["size"] for r in out)
    total = sum(len(brute.words(r[1])) for r in clean)
    assert abs(taken - 1.5 * total) < 4 * max(len(brute.words(r[1])) for r in clean)


def test_pipeline_runs_over_the_tables(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "source", "size", "epoch", "position"] and out.count() > 100
