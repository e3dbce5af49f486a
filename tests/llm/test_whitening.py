"""Operator 12 against numpy's eigenvalues and exact fractions."""

import math
from fractions import Fraction

import numpy as np
import pytest
from mercato.llm import queries, whitening
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def matrices():
    rng = np.random.default_rng(1)
    for d in (1, 2, 7, 40):
        y = rng.standard_normal((5 * d + 3, d))
        yield y.T @ y / len(y)
    q, _ = np.linalg.qr(rng.standard_normal((30, 30)))
    yield q @ np.diag(np.r_[np.ones(10) * 3, 1 + 1e-9 * np.arange(20)]) @ q.T  # equal, and nearly equal ones
    yield q @ np.diag(10.0 ** -np.arange(30)) @ q.T
    yield np.eye(6)
    yield np.diag([5.0, 5, 5, 1, 1, 0, 0])
    block = np.zeros((20, 20))
    block[:4, :4] = 1
    yield block
    yield np.zeros((3, 3))


@pytest.mark.parametrize("a", list(matrices()), ids=lambda a: str(len(a)))
def test_leading_eigenpairs(a):
    values, axes = whitening.leading_eigenpairs(a, 32)
    want = np.linalg.eigvalsh(a)[::-1]
    top = max(want[0], 1e-300)
    assert len(values) == min(32, int((want > len(a) * 2.0**-50 * np.abs(a).sum(axis=1).max()).sum()))
    assert np.allclose(values, want[: len(values)], rtol=0, atol=1e-13 * top) and list(values) == sorted(values, reverse=True)
    assert np.allclose(axes @ axes.T, np.eye(len(values)), atol=1e-12)
    assert np.allclose(axes @ a, values[:, None] * axes, rtol=0, atol=1e-13 * top)


def test_pivots_count_signs():
    rng = np.random.default_rng(2)
    for _ in range(300):
        d = int(rng.integers(1, 12))
        m = rng.integers(-2, 3, (d, d)).astype(float)
        m += m.T
        e = np.linalg.eigvalsh(m)
        if np.abs(e).min() > 1e-9:
            assert whitening.ldl_pivots(m) == ((e > 0).sum(), 0, (e < 0).sum())


def expected(vectors):
    """n, x-vectors, deviations, and numpy's whitened rows up to the sign of each component."""
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    total = [sum(col) for col in zip(*x, strict=True)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(v, total, strict=True)) for v in x]
    y = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(v, total, strict=True)] for v in x])
    cov = y.T @ y / n
    e, u = np.linalg.eigh(cov)
    k = min(32, int((e > d * 2.0**-50 * e[-1]).sum()))
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return n, deviation, y @ u / np.sqrt(e), e / np.trace(cov)


def check(rows, ids, vectors, atol=1e-7):
    n, deviation, white, share = expected(vectors)
    got = np.full(white.shape, np.nan)
    where = {i: j for j, i in enumerate(ids)}
    for r in rows:
        j = where[r["vec_id"]]
        got[j, r["component"] - 1] = r["whitened"]
        assert (r["n"], r["deviation"]) == (n, deviation[j])
        assert math.isclose(r["explained"], share[r["component"] - 1], rel_tol=1e-9) and r["identity_error"] <= 1e-9
    assert len(rows) == white.size and not np.isnan(got).any()
    signs = np.sign((got * white).sum(axis=0))
    assert np.allclose(got, white * signs, atol=atol)


def test_query(spark):
    held = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    check(queries.op12_whitening(spark, SF).collect(), [r["vec_id"] for r in held], [[float(c) for c in r["embedding"]] for r in held])


def table(spark, rows, more=""):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<double>{more}").repartition(3, "vec_id")


def test_rows_that_do_not_count(spark):
    rng = np.random.default_rng(3)
    good = [(i, rng.standard_normal(5).tolist()) for i in range(40)]
    good += [good[3], (50, good[3][1]), (51, [1e5, -1e5, 0.0, 1.0, 2.0])]  # repeated rows, equal vectors, wide values
    bad = [(60, None), (61, []), (62, [1.0, None, 2.0, 3.0, 4.0]), (63, [float("nan")] * 5), (64, [float("inf"), 0.0, 0.0, 0.0, 0.0]),
           (65, [1.0, 2.0]), (66, [1e300, 0.0, 0.0, 0.0, 0.0]), (67, [None] * 5)]
    rows = whitening.whiten(table(spark, good + bad), vec_id=F.col("vec_id")).collect()
    assert len(rows) == 5 * len(good) and {r["vec_id"] for r in rows} == {i for i, _ in good}
    n, deviation, white, share = expected([v for _, v in good])
    assert {(r["vec_id"], r["deviation"]) for r in rows} == {(i, d) for (i, _), d in zip(good, deviation, strict=True)}
    by = {(r["vec_id"], r["component"]): r["whitened"] for r in rows}
    got = np.array([[by[i, k] for k in range(1, 6)] for i, _ in good])
    assert np.allclose(np.abs(got), np.abs(white), atol=1e-6)
    assert all(r["identity_error"] < 1e-6 and r["n"] == n for r in rows)


def test_empty_and_flat_tables_and_clashing_names(spark):
    for rows in ([], [(1, None), (2, [])], [(1, [1.0, 2.0])], [(i, [0.5, 0.25, 0.125]) for i in range(5)]):
        assert whitening.whiten(table(spark, rows), vec_id=F.col("vec_id")).collect() == []
    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(3).tolist(), "x", None) for i in range(20)]
    clash = table(spark, rows, ", component string, __vector string")
    out = whitening.whiten(clash, most=2, vec_id=F.col("vec_id"))
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert sorted({r["component"] for r in out.collect()}) == [1, 2]
    null_ids = table(spark, [(None, v) for _, v, _, _ in rows])
    assert whitening.whiten(null_ids, vec_id=F.col("vec_id")).count() == 60


def test_deviations_beyond_a_bigint_are_null(spark):
    rows = [(1, [1e12, 0.0]), (2, [-1e12, 1.0]), (3, [0.0, 5.0])]
    out = {(r["vec_id"], r["deviation"]) for r in whitening.whiten(table(spark, rows), vec_id=F.col("vec_id")).collect()}
    assert {i: d for i, d in out}[1] is None and {i: d for i, d in out}[3] is not None


def test_how_rows_are_spread_does_not_matter(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.standard_normal(6).tolist()) for i in range(300)]
    one, two = (whitening.fit(table(spark, rows).repartition(k)) for k in (1, 7))
    assert np.array_equal(one.axes, two.axes) and np.array_equal(one.values, two.values) and one.total == two.total
