"""The pipeline's stages, each against a brute-force version on its own input."""

from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline as C
from riskpanel.llm.common import table, written
from tests.llm.helpers import dedup_lines, documents, near_components, read, words
from tests.llm.test_mixing import plain_targets

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    assert [n for n, _ in C.STAGES] == ["toxicity", "line_dedup", "near_dedup", "mixing", "packing"]
    assert C.ORACLE_SQL is None
    docs = table(spark, SF, "documents")
    kept = [docs]
    for name, stage in C.STAGES:
        docs = written(stage(spark, docs, SF), f"test-{name}")
        kept.append(docs)
        if name != "packing":
            assert docs.columns == kept[0].columns and docs.dtypes == kept[0].dtypes
    raw, clean, lines, near, mixed, packed = [x.collect() for x in kept]

    toxic = {r["doc_id"] for r in read(SF, "labels") if r["toxic"] == 1}
    ids = {r["doc_id"] for r in clean}
    assert {r["doc_id"] for r in raw if r["doc_id"] not in toxic} - ids == set()  # clean documents stay
    assert {(r["doc_id"], r["text"]) for r in clean} <= {(r["doc_id"], r["text"]) for r in raw}

    want = dedup_lines([(r["doc_id"], r["text"]) for r in clean])
    assert {r["doc_id"]: r["text"] for r in lines} == {i: t for i, (_, _, t) in want.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in lines)

    groups = near_components([(r["doc_id"], r["text"]) for r in lines], 80)
    assert {r["doc_id"] for r in near} == {i for i, (_, c) in groups.items() if i == c}

    sizes = Counter()
    for r in near:
        sizes[r["source"]] += len(words(r["text"]))
    target = plain_targets(sizes)
    taken, most = Counter(), Counter()
    for r in mixed:
        taken[r["source"]] += len(words(r["text"]))
    for r in near:
        most[r["source"]] = max(most[r["source"]], len(words(r["text"])))
    assert all(abs(taken[s] - t) <= most[s] for s, t in target.items())

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    lengths = Counter((r["doc_id"], len(tok.encode(r["text"] or "", add_special_tokens=False).ids) + 1) for r in mixed)
    assert sum(r["length"] for r in packed) == sum(n * k for (_, n), k in lengths.items())
    ends = Counter((r["doc_id"], r["doc_tokens"]) for r in packed
                   if np.frombuffer(bytes(r["ids"]), "<u4")[-1] == 2 and r["start"] + r["length"] == r["doc_tokens"])
    assert ends == lengths


def test_run_is_registered(spark):
    assert "pipeline" in __spark_entry__.queries()
    out = C.run(spark, SF)
    assert out.count() > 0 and {"doc_id", "ids", "sequence_id", "offset"} <= set(out.columns)


def test_near_dedup_stage_links_from_four_fifths(spark):
    base = [f"w{i}" for i in range(100)]  # 96 shingles; changing the last n words changes n of them
    docs = [(1, " ".join(base))] + [(10 + n, " ".join(base[:100 - n] + [f"x{n}-{j}" for j in range(n)])) for n in (8, 10, 11)]
    far = {i: c for i, (_, c) in near_components(docs, 80).items()}
    assert far == {1: 1, 18: 1, 20: 1, 21: 21} and near_components(docs)[18][1] == 18
    near = C.near_dedup_stage(spark, documents(spark, docs), SF).collect()
    assert {r["doc_id"] for r in near} == {1, 21}
    docs = [(r["doc_id"], r["text"]) for r in read("/root/testdata/sf0.01", "documents")]
    near = C.near_dedup_stage(spark, documents(spark, docs), SF).collect()
    assert {r["doc_id"] for r in near} == {i for i, (_, c) in near_components(docs, 80).items() if i == c}


def test_stages_give_back_clashing_columns(spark):
    names = ["size", "source_size", "target", "copies", "n_lines", "n_dropped", "score", "predicted", "__lines", "__doc", "__drop",
             "__i", "u_doc", "__stay", "others", "n", "rep", "node", "h", "lang"]
    base = [(i, " ".join(f"w{i}x{j}" for j in range(30)), f"s{i % 2}") for i in range(12)] + [(50, None, None), (51, "", "s0")]
    docs = spark.createDataFrame([(*r, *[f"{n}-{r[0]}" for n in names]) for r in base],
                                 "doc_id long, text string, source string, " + ", ".join(f"`{n}` string" for n in names))
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        docs = written(out, f"test-clash-{name}")
        rows = docs.collect()
        assert rows and all(r[n] == f"{n}-{r['doc_id']}" for r in rows for n in names), name
