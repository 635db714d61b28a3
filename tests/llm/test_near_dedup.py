import random

import numpy as np
import pytest

from riskpanel.llm import near_dedup as N
from riskpanel.llm import queries
from riskpanel.llm.components import connected_components
from tests.llm.helpers import documents, near_components, read, shingle_set

SF = "/root/testdata/sf0.01"


def corpus(seed, families, copies, n=80):
    r = random.Random(seed)
    docs, i = [], 0
    for _ in range(families):
        base = [f"w{r.randrange(5000)}" for _ in range(n)]
        for _ in range(copies):
            w = list(base)
            for _ in range(r.randrange(4)):
                w[r.randrange(n)] = f"x{r.randrange(10 ** 6)}"
            docs.append((i, " ".join(w)))
            i += 1
    return docs


def result(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def expected(docs):
    return {i: (n, c, i == c) for i, (n, c) in near_components(docs).items()}


@pytest.mark.parametrize("block", [1024, 7])
def test_components_match_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(N, "BLOCK_DOCS", block)  # 7: every family is a large cluster compared in blocks
    docs = corpus(3, 6, 25) + corpus(4, 40, 1, n=7)
    docs = [(i, t) for i, (_, t) in enumerate(docs)]
    assert result(N.near_duplicates(documents(spark, docs))) == expected(docs)


def test_odd_rows(spark):
    docs = [(0, "a b c d e f g"), (1, "A  b\tC d e\nf g"), (2, None), (3, ""), (4, " \t "), (5, "one two"), (6, "One Two "),
            (7, "two one"), (8, "é ê"), (9, "É ê"), (10, "a b c d e f g"), (11, "w " * 30_000)]
    assert result(N.near_duplicates(documents(spark, docs))) == expected(docs)
    again = N.near_duplicates(documents(spark, docs + [(10, "a b c d e f g")])).collect()
    assert len(again) == 13 and sorted(r["component_id"] for r in again if r["doc_id"] == 10) == [0, 0]
    odd = {r["component_id"] for r in N.near_duplicates(documents(spark, [(None, "a b c d e"), (None, None)])).collect()}
    assert odd == {None}
    assert N.near_duplicates(documents(spark, [])).count() == 0


def test_one_of_each_group_stays_with_all_columns(spark):
    docs = [(5, "a b c d e f", "en", "s"), (6, "a b c d e f", "en", "s"), (7, "z", None, None), (None, "a b c d e f", None, None)]
    kept = N.drop_near_duplicates(documents(spark, docs))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == [-1, 5, 7]


def test_similarity_is_exact():
    r = np.random.Generator(np.random.PCG64(5))
    pool = r.integers(0, 2 ** 63, 400, dtype=np.uint64)
    sets = [np.unique(r.choice(pool, r.integers(1, 60))) for _ in range(30)]
    sets += [np.unique(np.append(sets[0], [np.uint64(9)])), sets[0]] + [pool[:300]] * 40
    got = N.similar(sets, 85)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            both = len(np.intersect1d(a, b))
            assert got[i, j] == (i != j and 100 * both >= 85 * (len(a) + len(b) - both) and both > 0)


def test_set_sizes_count_distinct_shingles():
    for t in ("a a a a a a a", "a b c d", "a b c d e", "", "x " * 500 + "y"):
        assert len(N.shingles(N.words_of(t.encode()))) == len(shingle_set(t))


def test_components_of_random_graphs(spark):
    r = random.Random(8)
    edges = [(r.randrange(60), r.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(40)]
    root = {}
    for a, b in edges:
        root.setdefault(a, a), root.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(root[a], root[b])
            changed |= root[a] != m or root[b] != m
            root[a] = root[b] = m
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    loops = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    assert got == {k: v for k, v in root.items() if k not in loops}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_query_matches_all_pairs(spark):
    docs = [(r["doc_id"], r["text"]) for r in read(SF, "documents")]
    assert result(queries.op2_near_dedup(spark, SF)) == expected(docs)


def test_an_id_with_two_texts_links_through_both(spark):
    a, b = ([f"{x}{i}" for i in range(100)] for x in "ab")
    docs = [(1, " ".join(a)), (1, " ".join(b)), (2, " ".join(a[:-1] + ["x"])), (3, " ".join(b[:-1] + ["x"])), (4, "alone here")]
    got = {(r["doc_id"], r["component_id"], r["kept"]) for r in N.near_duplicates(documents(spark, docs)).collect()}
    assert got == {(1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True)}
