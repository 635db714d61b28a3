import hashlib
import random

import duckdb
import pytest

from riskpanel.llm import line_dedup as D
from riskpanel.llm import queries
from tests.llm.helpers import dedup_lines, documents, read

SF = "/root/testdata/sf0.001"


def result(df):
    return {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["text"]) for r in df.collect()}


@pytest.mark.parametrize("batches,fanout", [(1, 4), (5, 2), (9, 3)])
def test_matches_a_plain_loop(spark, batches, fanout):
    r = random.Random(batches)
    pool = [f"A line that many documents may share, number {i}" for i in range(30)] + ["short", "", "  \t"]
    docs = [(i, "\n".join(r.choice([x, x.upper(), f"  {x}\t"]) for x in r.choices(pool, k=r.randrange(1, 9))))
            for i in range(60)]
    got = result(D.dedup_lines(documents(spark, docs), batches=batches, fanout=fanout))
    assert got == dedup_lines(docs)


def test_odd_rows(spark):
    line = "exactly twenty chars"
    assert len(line) == 20
    docs = [(1, None), (2, ""), (3, line), (4, f"{line}\n{line}\nx"), (5, line.upper()), (6, "é" * 19), (7, "é" * 20), (8, "é" * 20),
            (9, "É" * 20), (10, "é" * 20), (11, "long " * 100_000)]
    df = documents(spark, docs).withColumnRenamed("lang", "n_lines")
    out = D.dedup_lines(df)
    assert out.columns == ["doc_id", "text", "source", "n_chars", "n_lines", "n_dropped"]
    assert result(out) == dedup_lines(docs)
    assert D.dedup_lines(documents(spark, [])).count() == 0


def test_null_ids_and_repeated_rows(spark):
    line = "a line long enough to count here"
    rows = [(None, line), (None, line), (1, line), (2, line), (2, line)]
    got = sorted((r["doc_id"] or 0, r["n_dropped"]) for r in D.dedup_lines(documents(spark, rows)).collect())
    assert got == [(0, 1), (0, 1), (1, 1), (2, 0), (2, 0)]
    two = [(None, line), (2, line), (2, line)]  # one document twice is not three
    assert all(r["n_dropped"] == 0 for r in D.dedup_lines(documents(spark, two)).collect())


def test_a_hot_line_is_dropped_everywhere_but_once(spark, monkeypatch):
    line = "the one line that every document has in common"
    docs = [(i, f"{line}\nown line of document number {i}") for i in range(1500)]
    got = D.dedup_lines(documents(spark, docs)).agg({"n_dropped": "sum"}).first()[0]
    assert got == 1499


def test_runs_share_no_key_and_compact(spark):
    runs = D.LineRuns(fanout=2)
    for b in range(4):
        rows = [((h, 0), b * 10 + h % 3) for h in range(b, b + 5)]
        runs.add(spark.createDataFrame([(d, k) for k, d in rows], "doc long, k struct<h1:long,h2:long>"))
    keys = [r["k"]["h1"] for r in runs.stored().collect()]
    assert sorted(keys) == list(range(8)) and sum(map(len, runs.levels)) < 4
    assert {r["k"]["h1"]: r["n_docs"] for r in runs.repeated(4).collect()} == {3: 4, 4: 4}


def test_plan_is_native(spark):
    plan = queries.op4_line_dedup(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_query_matches_its_sql_and_a_loop(spark):
    docs = [(r["doc_id"], r["text"]) for r in read(SF, "documents")]
    want = {i: (n, d, hashlib.sha256(t.encode()).hexdigest()) for i, (n, d, t) in dedup_lines(docs).items()}
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in queries.op4_line_dedup(spark, SF).collect()}
    assert got == want
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    assert {r[0]: r[1:] for r in con.execute(queries.OP4_SQL).fetchall()} == want
