from collections import Counter

import public_tokenizers

from riskpanel.llm import queries
from riskpanel.llm import token_counts as C
from tests.llm.helpers import documents, read

SF = "/root/testdata/sf0.01"
PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def brute(lengths):
    n, hist = len(lengths), Counter(lengths)
    return {k: (c, k * c, sum(x <= k for x in lengths), sum(x > k for x in lengths), n, sum(lengths),
                sum(min(x, k) for x in lengths), sum(x <= k for x in lengths) / n) for k, c in hist.items()}


def rows(df):
    return {r["length"]: tuple(r)[1:] for r in df.collect()}


def test_sums_match_a_plain_loop(spark):
    texts = [None, "", "one", "one", "two words here", "<|endoftext|>", "é" * 30, "a b " * 60_000] + ["x y z " * i for i in range(40)]
    enc = C.encoder(PATH, PATTERN)
    lengths = [len(enc.encode_ordinary(t or "")) for t in texts]
    df = documents(spark, [(i % 9, t) for i, t in enumerate(texts)]).withColumnRenamed("n_chars", "length")
    for block in (4096, 5):
        hist = C.length_histogram(df, PATH, PATTERN, block)
        assert rows(hist) == brute(lengths)
    got = {r["limit"]: (r["kept_tokens"], r["docs_cut"]) for r in C.tokens_within(hist, [0, 7, 10 ** 6]).collect()}
    assert got == {k: (sum(min(x, k) for x in lengths), sum(x > k for x in lengths)) for k in (0, 7, 10 ** 6)}


def test_empty(spark):
    hist = C.length_histogram(documents(spark, []), PATH, PATTERN)
    assert hist.count() == 0
    assert [tuple(r) for r in C.tokens_within(hist, [5]).collect()] == [(5, 0, 0)]


def test_query(spark):
    enc = C.encoder(PATH, PATTERN)
    assert rows(queries.op6_token_counts(spark, SF)) == brute([len(enc.encode_ordinary(r["text"] or "")) for r in read(SF, "documents")])
