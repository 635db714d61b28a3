import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from riskpanel.llm import queries
from riskpanel.llm import token_files as F
from riskpanel.llm.common import scratch_folder
from tests.llm.helpers import documents, read

SF = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("word_bpe_49k.json")


def encode(texts, end=1):
    t = Tokenizer.from_file(PATH)
    return [[*e.ids, end] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_query_gives_every_document_in_order(spark):
    docs = sorted(read(SF, "documents"), key=lambda r: r["doc_id"])
    want, at = {}, 0
    for r, ids in zip(docs, encode([r["text"] for r in docs])):
        want[r["doc_id"]] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in queries.op13_token_files(spark, SF).collect()}
    assert got == want


def test_files_hold_equal_sequences_and_masks(spark, monkeypatch):
    texts = [(3, "a b c"), (1, None), (2, ""), (None, "no id"), (7, "x y " * 9000), (2, "again"), (2, "again"), (5, "Ä! 日本")]
    df = documents(spark, texts).withColumnRenamed("lang", "start").withColumnRenamed("source", "part")
    folder = scratch_folder(spark, "test-tokens")
    manifest = F.write_token_files(df, folder, PATH, end_id=1, length=8, parts=3)
    rows = sorted(manifest.collect(), key=lambda r: r["part"])
    assert sum(r["n_docs"] for r in rows) == len(texts)
    seqs = F.read_sequences(manifest, folder).orderBy("part", "sequence").collect()
    stream = []
    for r in rows:
        own = [s for s in seqs if s["part"] == r["part"]]
        assert [s["sequence"] for s in own] == list(range(r["n_sequences"])) and r["n_sequences"] == -(-r["n_tokens"] // 8)
        file = F.TokenFile(folder, r["tokens"])
        for s in own:
            ids, mask = file.sequence(s["sequence"])
            assert ids.tolist() == s["ids"] and mask.to_pylist() == s["mask"] and len(ids) == 8
            assert not ids.flags.owndata and ids.base is not None  # a view of the mapped file
        flat = [i for s in own for i, m in zip(s["ids"], s["mask"]) if m]
        assert len(flat) == r["n_tokens"] and [m for s in own for m in s["mask"]] == [1] * len(flat) + [0] * (8 * len(own) - len(flat))
        stream += flat
    got = F.read_documents(manifest, folder, with_ids=True).orderBy("start").collect()
    order = [r["doc_id"] for r in got]
    assert order == sorted(order, key=lambda x: (x is not None, x or 0))
    for r in got:
        ids = stream[r["start"]:r["start"] + r["n_tokens"]]
        assert np.frombuffer(bytes(r["ids"]), "<u4").tolist() == ids and r["ids_crc32"] == zlib.crc32(bytes(r["ids"]))
    assert Counter((r["doc_id"], bytes(r["ids"])) for r in got) == Counter(
        (i, np.array(x, "<u4").tobytes()) for (i, _), x in zip(texts, encode([t for _, t in texts])))


def test_empty_table(spark):
    folder = scratch_folder(spark, "test-tokens")
    manifest = F.write_token_files(documents(spark, []), folder, PATH, end_id=1)
    assert manifest.count() == 0 and F.read_documents(manifest, folder).count() == 0
    assert F.read_sequences(manifest, folder).count() == 0
