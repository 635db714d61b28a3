from collections import Counter

import numpy as np

from riskpanel.llm import language_id as L
from riskpanel.llm import queries
from tests.llm.helpers import documents, held_out, read

SF = "/root/testdata/sf0.01"


def grams_of(text):
    s, out = " ", []
    for c in text.lower():
        if c.isalpha():
            s += c
        elif s[-1] != " ":
            s += " "
    s = s if s[-1] == " " else s + " "
    return Counter(s[i:i + 3] for i in range(len(s) - 2)) if len(s) > 2 else Counter()


def test_grams_match_a_plain_count():
    texts = ["Hello, World", "", "123 !?", "a", "Été  à la  plage\n\n", "x" * 50, "日本語 テキスト", "İstanbul"]
    of, index, n, grams = L.count_grams(texts)
    got = [Counter() for _ in texts]
    for d, g, k in zip(of, index, n):
        got[d]["".join(map(chr, grams[g]))] += int(k)
    assert got == [grams_of(t) for t in texts]


def test_binding_permutes_and_multiplies():
    v = L.gram_vectors(np.array([[97, 98, 99]]), 64)[0]
    a, b, c = (L.letter_vector(x, 64) for x in (97, 98, 99))
    assert (v == np.roll(a, 2) * np.roll(b, 1) * c).all()
    assert set(np.unique(a)) == {-1, 1}


def test_learn_and_predict_with_odd_rows(spark):
    rows = [(i, "the cat sat on the mat and the dog ran", "en") for i in range(5)]
    rows += [(10 + i, "der hund und die katze sind nicht hier", "de") for i in range(5)]
    rows += [(20, None, "en"), (21, "some text", None), (None, "", "de")]
    langs, proto = L.collect_prototypes(L.learn_prototypes(documents(spark, rows)))
    assert langs == ["de", "en"]
    ask = documents(spark, [(1, "the dog and the cat"), (1, "the dog and the cat"), (2, "die katze und der hund"), (3, None),
                            (4, ""), (5, "42 + 7"), (None, "the mat"), (6, "the cat " * 200_000)])
    ask = ask.withColumnRenamed("lang", "lang_pred").withColumnRenamed("n_chars", "score")
    got = sorted((r["doc_id"] or 0, r["lang_pred"], 0 <= r["score"] <= 1) for r in L.predict_language(ask, langs, proto).collect())
    assert got == [(0, "en", True), (1, "en", True), (1, "en", True), (2, "de", True), (3, "und", True), (4, "und", True),
                   (5, "und", True), (6, "en", True)]


def test_nothing_learned_and_nothing_asked(spark):
    empty = documents(spark, [])
    langs, proto = L.collect_prototypes(L.learn_prototypes(empty))
    assert langs == []
    assert [r["lang_pred"] for r in L.predict_language(documents(spark, [(1, "abc")]), langs, proto).collect()] == ["und"]
    assert L.predict_language(empty, langs, proto).count() == 0


def test_a_long_text_in_parts_counts_like_its_whole():
    for text in ["the cat sat on the mat. " * 100, "Été  à la  plage\n\n1, 2" * 30, "日本語テキスト" * 60, "...a" * 99, "12 " * 200, "x" * 400 + "  "]:
        for chunk in (7, 64, 300, 10_000):
            grams, n = L.long_counts(text, chunk)
            assert Counter({"".join(map(chr, g)): k for g, k in zip(grams.tolist(), n.tolist())}) == grams_of(text), (text[:20], chunk)


def plain_vector(text):
    v = np.zeros(L.DIM)
    for gram, n in grams_of(text).items():
        bound = np.ones(L.DIM)
        for i, c in enumerate(gram):
            bound = bound * np.roll(L.letter_vector(ord(c), L.DIM), L.GRAM - 1 - i)
        v += np.sqrt(n) * bound
    return v


def same_scores(got, proto, texts):
    langs = sorted(proto)
    unit = np.array([proto[x] / np.linalg.norm(proto[x]) for x in langs])
    for r in got:
        v = plain_vector(texts[r["doc_id"]] or "")
        if not v.any():
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        cos = unit @ v / np.linalg.norm(v)
        assert abs(r["score"] - max(0, cos.max())) < 1e-5 and cos[langs.index(r["lang_pred"])] > cos.max() - 1e-5


def test_query_equals_a_plain_version(spark):
    docs = read("/root/testdata/sf0.001", "documents")
    proto = {}
    for lang in {r["lang"] for r in docs} - {None}:
        whole = Counter()
        for r in docs:
            if r["lang"] == lang and r["text"] is not None and not held_out(r["doc_id"]):
                whole.update({g: np.sqrt(n) for g, n in grams_of(r["text"]).items()})
        v = np.zeros(L.DIM)
        for gram, w in whole.items():
            bound = np.ones(L.DIM)
            for i, c in enumerate(gram):
                bound = bound * np.roll(L.letter_vector(ord(c), L.DIM), L.GRAM - 1 - i)
            v += w * bound
        proto[lang] = v
    same_scores(queries.op1_language_id(spark, "/root/testdata/sf0.001").collect(), proto, {r["doc_id"]: r["text"] for r in docs})


def test_very_long_texts_and_large_alphabets(spark):
    han = "".join(chr(0x4E00 + 37 * i % 6000) for i in range(30_000))  # more n-grams than are held at once
    texts = {1: "the cat sat on the mat. " * (2 * L.CHUNK // 24 + 2000), 2: han, 3: "the cat", 4: "der hund"}
    docs = documents(spark, list(texts.items()))
    langs, proto = L.collect_prototypes(L.learn_prototypes(documents(spark, [(1, "the cat sat", "en"), (2, "der hund", "de"), (3, han[:20_000], "zh")])))
    same_scores(L.predict_language(docs, langs, proto).collect(), dict(zip(langs, proto)), texts)


def test_query_held_out_accuracy(spark):
    truth = {r["doc_id"]: r["lang"] for r in read(SF, "documents")}
    got = queries.op1_language_id(spark, SF).collect()
    assert len(got) == len(truth)
    assert all(r["held_out"] == held_out(r["doc_id"]) and 0 <= r["score"] <= 1 for r in got)
    out = [r for r in got if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in out) / len(out) > 0.97
