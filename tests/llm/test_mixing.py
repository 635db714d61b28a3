import random
from collections import Counter, defaultdict

import pandas as pd
import pytest

from riskpanel.llm import mixing as M
from riskpanel.llm import queries
from tests.llm.helpers import documents, read, words

SF = "/root/testdata/sf0.01"


def plain_targets(sizes, share=1.5, most=2.0, weights=(5, 2, 1)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, left = {}, set(names), share * sum(sizes.values())
    while free:
        each = left / sum(weight[s] for s in free)
        over = {s for s in free if each * weight[s] > most * sizes[s]}
        if not over:
            target |= {s: each * weight[s] for s in free}
            break
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        free -= over
    return target


@pytest.mark.parametrize("seed", range(4))
def test_targets_match_a_plain_loop(spark, seed):
    r = random.Random(seed)
    sizes = {f"s{i}": r.choice([0, 5, 100, 5000, 10 ** 6]) for i in range(r.randrange(1, 15))} | {None: 70, "": 9, "é": 50}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {x["source"]: x["target"] for x in M.source_targets(df).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def test_rounding_keeps_words_and_expectations():
    r = random.Random(5)
    size = [r.randrange(1, 500) for _ in range(200)]
    taken = Counter()
    for t in range(300):
        pdf = pd.DataFrame({"doc": [str(i) for i in range(200)], "size": size, "draw": [r.random() for _ in size], "p": 0.3})
        out = M._settle(pdf)
        assert ((out["p"] > 0) & (out["p"] < 1)).sum() <= 1
        assert (out["p"] * out["size"]).sum() == pytest.approx(0.3 * sum(size))
        taken.update(out.loc[out["p"] == 1, "doc"])
    rate = [taken[str(i)] / 300 for i in range(200)]
    assert abs(sum(rate) / 200 - 0.3) < 0.02 and max(rate) < 0.5 and min(rate) > 0.1


def check(got, docs, share=1.5):
    sizes = defaultdict(int)
    for i, t, s in docs:
        sizes[s] += len(words(t))
    target, taken, largest = plain_targets(sizes, share), defaultdict(int), defaultdict(int)
    for x in got:
        assert x["source_size"] == sizes[x["source"]]
        assert x["target"] == pytest.approx(target[x["source"]])
        assert 0 <= x["copies"] <= 2 and (x["size"] or not x["copies"])
        taken[x["source"]] += x["copies"] * x["size"]
        largest[x["source"]] = max(largest[x["source"]], x["size"])
    for s in target:
        assert abs(taken[s] - target[s]) <= largest[s]


@pytest.mark.parametrize("block", [4096, 8])
def test_sources_come_near_their_targets(spark, monkeypatch, block):
    monkeypatch.setattr(M, "BLOCK", block)  # 8: several levels of the reduction tree
    r = random.Random(block)
    docs = [(i, "w " * r.randrange(1, 60), r.choice(["a", "a", "a", "b", "c", None])) for i in range(500)]
    df = documents(spark, [(i, t, None, s) for i, t, s in docs])
    got = M.mix(df).collect()
    assert len(got) == 500
    check(got, docs)
    assert sorted(map(str, got)) == sorted(map(str, M.mix(df.repartition(3)).collect()))  # reruns agree


def test_odd_rows(spark):
    docs = [(1, None, "a"), (2, "", "a"), (3, "x y", "b"), (3, "x y", "b"), (None, "z z z", None), (4, " \t", "empty"), (5, "w " * 100_000, "a")]
    df = documents(spark, [(i, t, None, s) for i, t, s in docs]).withColumnRenamed("lang", "size")
    got = M.mix(df).collect()
    assert len(got) == len(docs) and all(x["copies"] == 0 for x in got if x["size"] == 0)
    assert len({x["copies"] for x in got if x["doc_id"] == 3}) == 1
    assert M.mix(documents(spark, [])).count() == 0
    rows = M.mixed_rows(df.withColumnRenamed("size", "lang"))
    assert rows.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert rows.count() == sum(x["copies"] for x in got)


def test_query(spark):
    docs = [(r["doc_id"], r["text"], r["source"]) for r in read(SF, "documents")]
    source = {i: s for i, _, s in docs}
    got = queries.op9_mixing(spark, SF).collect()
    assert len(got) == len(docs)
    check([{"source": source[r["doc_id"]], "size": r["size"], "source_size": r["source_size"], "target": r["target"],
            "copies": r["taken"] // r["size"] if r["size"] else 0} for r in got], docs)
