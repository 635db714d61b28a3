import math

import numpy as np
import pytest

from riskpanel.llm import queries
from riskpanel.llm import whitening as W
from tests.llm.helpers import read

SF = "/root/testdata/sf0.01"


def plain(rows, k):
    """{(id, component): values} of (id, vector) rows, by numpy's own eigenvalues on the distinct vectors."""
    x = [(i, [math.floor(256 * float(c)) for c in v]) for i, v in rows
         if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(v) for _, v in x}))
    n, sums = len(fit), [int(s) for s in fit.sum(axis=0)]
    mean = np.array([s / n for s in sums])
    v = (fit - mean).T @ (fit - mean) / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1].T
    out = {}
    for i, row in x:
        for c in range(min(k, len(values))):
            if values[c] > 1e-13 * np.trace(v):
                out[i, c + 1] = (n, sum((n * a - s) ** 2 for a, s in zip(row, sums)),
                                 float((np.array(row) - mean) @ vectors[c] / math.sqrt(values[c])), values[c] / np.trace(v))
    return out


def same(got, want):
    assert {(r["vec_id"], r["component"]) for r in got} == want.keys()
    signs = {}
    for r in got:
        n, deviation, white, explained = want[r["vec_id"], r["component"]]
        assert (r["n"], r["deviation"]) == (n, deviation) and r["explained"] == pytest.approx(explained, rel=1e-9)
        if abs(white) > 1e-6:
            assert signs.setdefault(r["component"], white * r["whitened"] > 0) == (white * r["whitened"] > 0)
        assert abs(r["whitened"]) == pytest.approx(abs(white), rel=1e-7, abs=1e-9) and r["identity_error"] < 1e-8


def test_query_equals_a_plain_version(spark):
    got = queries.op12_whitening(spark, SF).collect()
    same(got, plain([(r["vec_id"], r["embedding"]) for r in read(SF, "embeddings")], 4))


def test_counts_are_the_numbers_of_eigenvalues():
    rng = np.random.Generator(np.random.PCG64(5))
    for n in (1, 2, 3, 7, 20):
        for _ in range(20):
            a = rng.integers(-3, 4, (n, n)).astype(float)
            a = a + a.T
            values = np.linalg.eigvalsh(a)
            for s in [*rng.uniform(-9, 9, 6), *(values + 1e-6), *(values - 1e-6)]:
                assert W.count_above(a, s) == int((values > s).sum())


def test_components_of_hard_spectra():
    rng = np.random.Generator(np.random.PCG64(6))
    for values in ([5, 5, 5, 1], [4, 4 - 1e-12, 1, 1e-3], [1, 0, 0, 0], [3, 2, 1 + 1e-9, 1], [1e12, 1, 1e-3, 1e-6], [0, 0, 0, 0]):
        q = np.linalg.qr(rng.standard_normal((4, 4)))[0]
        v = q @ np.diag(np.array(values, float)) @ q.T
        v = (v + v.T) / 2
        got, vectors = W.leading_components(v, 4)
        want = [x for x in sorted(values, reverse=True) if x > 1e-13 * sum(values)]
        assert len(got) == len(want) and np.allclose(got, want, rtol=1e-9, atol=1e-12 * max(values))
        assert np.allclose(vectors @ vectors.T, np.eye(len(got)), atol=1e-9)
        assert np.abs(vectors @ v - got[:, None] * vectors).max(initial=0) <= 1e-12 * max(1, max(values))
    assert W.leading_components(np.zeros((0, 0)), 4)[0].size == 0


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0, 3.0]), (1, [1.0, 2.0, 3.0]), (2, [0.5, 2.0, -1.0]), (None, [4.0, -1.0, 0.0]), (3, None),
            (4, [1.0, None, 2.0]), (5, [nan, 0.0, 0.0]), (6, [inf, 0.0, 0.0]), (7, [1.0, 2.0]), (8, []), (9, [-0.0, 0.1, 3.0]),
            (10, [7.0, 1.0, 2.0])]
    df = spark.createDataFrame([(*r, 0, 0) for r in rows], "vec_id long, embedding array<double>, n int, component int")
    got = W.whiten(df, k=4).collect()
    want = plain([r for r in rows if r[1] is None or len(r[1]) == 3], 4)
    assert len(got) == 3 * 6 and {r["component"] for r in got} == {1, 2, 3}
    same(got, want)
    schema = "vec_id long, embedding array<float>"
    assert W.whiten(spark.createDataFrame([], schema)).count() == 0
    assert W.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 3, schema)).count() == 0
    assert W.whiten(spark.createDataFrame([(1, []), (2, None)], schema)).count() == 0


def test_large_values_stay_exact(spark):
    rows = [(i, [float(i % 5 * 1e9), float(i * 3e8), 1.0 + i]) for i in range(8)]
    got = W.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=1).collect()
    want = plain(rows, 1)
    assert {r["vec_id"]: int(r["deviation"]) for r in got} == {i: v[1] for (i, _), v in want.items()}
