import math

import duckdb
import numpy as np

from riskpanel.llm import approximate_neighbours as A
from riskpanel.llm import exact_topk as E
from riskpanel.llm import queries, vectors
from tests.llm.helpers import read

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)


def usable(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v)


def brute_top(rows, every, k):
    whole = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and usable(v)]
    out = []
    for q, a in sorted({i: v for i, v in whole if i % every == 0}.items()):
        found = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in whole if i != q and len(a) == len(b))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return out


def brute_near(rows, every, k):
    whole = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if i is not None and usable(v) and any(v)]
    out = []
    for q, a in sorted({i: v for i, v in whole if i % every == 0}.items(), key=lambda x: x[0]):
        found = sorted((float(np.sqrt(((a - b) ** 2).sum())), i) for i, b in whole if i != q and len(a) == len(b))
        out += [(q, r + 1, i, s) for r, (s, i) in enumerate(found[:k])]
    return out


def odd_rows(seed, n=700, dim=16):
    g = np.random.Generator(np.random.PCG64(seed))
    rows = [(i, [float(x) for x in g.normal(size=dim)]) for i in range(n)]
    rows += [(n + i, rows[0][1]) for i in range(300)]  # a very common vector: ties
    return rows + [(2000, None), (2100, []), (2200, [float("nan")] * dim), (2300, [float("inf")] + [0.0] * (dim - 1)),
                   (2400, [None] * dim), (2500, [0.0] * dim), (None, rows[1][1]), (2600, [1.0, 2.0]), (2700, [2.0, 1.0])]


def got(df):
    return sorted(tuple(r) for r in df.collect())


def test_top_k_matches_all_products(spark, monkeypatch):
    rows = odd_rows(1)
    want = brute_top(rows, 50, 5)
    assert got(E.exact_top_k(table(spark, rows), 50, 5)) == want
    monkeypatch.setattr(vectors, "SHARD_ROWS", 40)
    monkeypatch.setattr(vectors, "BLOCK_ROWS", 5)
    assert got(E.exact_top_k(table(spark, rows), 50, 5)) == want


def test_few_and_no_rows(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.5, -1.0]), (100, [0.0, 1.0])]
    assert got(E.exact_top_k(table(spark, rows), 50, 5)) == brute_top(rows, 50, 5)
    assert got(A.nearest_neighbours(table(spark, rows), 100, 10)) == brute_near(rows, 100, 10)
    for f in (E.exact_top_k, A.nearest_neighbours):
        assert f(table(spark, [])).count() == 0
        assert f(table(spark, [(100, [1.0, 2.0])])).count() == 0
    repeated = [(100, [1.0, 2.0]), (100, [1.0, 2.0]), (1, [3.0, 1.0]), (1, [3.0, 1.0])]
    assert got(E.exact_top_k(table(spark, repeated), 50, 5)) == [(100, 1, 1, 327680), (100, 2, 1, 327680)]


def test_bounds_of_a_ball_hold():
    g = np.random.Generator(np.random.PCG64(3))
    m = g.normal(size=(900, 8)) * 100
    ids, tree_m, centre, radius, span, kids = E.build_tree(np.arange(900), m)
    assert sorted(ids) == list(range(900)) and (tree_m == m[ids]).all()
    for c, r, (lo, hi) in zip(centre, radius, span):
        assert (np.sqrt(((tree_m[lo:hi] - c) ** 2).sum(1)) <= r + 1e-9).all()


def test_estimates_are_close_and_bounded():
    g = np.random.Generator(np.random.PCG64(4))
    m, q = g.normal(size=(800, 64)), g.normal(size=(20, 64))
    estimate, error = A.distance_bounds(A.build_codes(np.arange(800), m), q)
    true = ((q[:, None, :] - m[None]) ** 2).sum(2)
    assert (np.abs(estimate - true) <= error).mean() > 0.93
    assert abs((estimate - true).mean()) < 0.05 * true.mean()


def test_neighbours_recall_and_scores(spark, monkeypatch):
    monkeypatch.setattr(vectors, "SHARD_ROWS", 100)
    rows = odd_rows(2)
    want = {(q, i): s for q, r, i, s in brute_near(rows, 100, 10)}
    true = {i: np.array(v, np.float32).astype(float) for i, v in rows if i is not None and usable(v)}
    found = got(A.nearest_neighbours(table(spark, rows), 100, 10))
    assert all(abs(s - np.sqrt(((true[q] - true[i]) ** 2).sum())) < 1e-12 for q, _, i, s in found)
    assert len([1 for q, _, i, _ in found if (q, i) in want]) >= 0.9 * len(want)
    assert [r for q, r, _, _ in found if q == 100] == list(range(1, 11))


def test_queries(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in read(SF, "embeddings")]
    want = brute_top(rows, 50, 5)
    assert got(queries.op7_exact_topk(spark, SF)) == want
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    assert sorted(con.execute(queries.OP7_SQL).fetchall()) == want
    near = {(q, i) for q, _, i, _ in brute_near(rows, 100, 10)}
    found = got(queries.op8_neighbours(spark, SF))
    assert len(near & {(q, i) for q, _, i, _ in found}) >= 0.9 * len(near)
