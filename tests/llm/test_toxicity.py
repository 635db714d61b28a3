import random
from functools import lru_cache

from riskpanel.llm import queries
from riskpanel.llm import toxicity as X
from tests.llm.helpers import documents, held_out, read

SF = "/root/testdata/sf0.1"


def distance(a, b):
    @lru_cache(None)
    def d(i, j):
        if not i or not j:
            return i + j
        return min(d(i - 1, j) + 1, d(i, j - 1) + 1, d(i - 1, j - 1) + (a[i - 1] != b[j - 1]))
    return d(len(a), len(b))


def test_automaton_agrees_with_edit_distances():
    words = {"idiot": 3.0, "moron": 2.0, "disgusting": 4.0, "bad": 1.0, "pathetic": 2.5, "pathetically": 1.5}
    lex, r = X.Lexicon(words, {}), random.Random(1)
    seen = 0
    for _ in range(4000):
        w = list(r.choice(list(words)))
        for _ in range(r.randrange(4)):
            p = r.randrange(len(w) + 1)
            kind = r.randrange(3)
            if kind == 0:
                w.insert(p, r.choice("abdeimnort1"))
            elif p < len(w):
                w[p:p + 1] = [] if kind == 1 else [r.choice("abdeimnort@")]
        w = "".join(w)
        near = [(distance(w, t), -x, t) for t, x in words.items() if distance(w, t) <= X.allowed_edits(t)]
        e, x, t = min(near, default=(0, 0, ""))
        want = None if not near else (2 if e else 1, -x * (1 - X.EDIT_LOSS * e), t)
        assert lex.read(w) == want, w
        seen += want is not None
    assert seen > 1000


def test_word_beginnings_match_exactly():
    lex = X.Lexicon({"idiot": 3.0}, {"stup": 2.0, "stupid": 2.5})
    assert lex.read("stupor") == (3, 2.0, "") and lex.read("stupidity") == (3, 2.5, "")
    exact = X.Lexicon({"idiot": 3.0, "clown": 1.0}, {}, frozenset({"idiot"}))
    assert exact.read("idiot") and exact.read("idi0t") is None and exact.read("cl0wn")
    assert lex.read("stp") is None and lex.read("") is None and lex.read("x" * 500) is None


def test_context_separates_quotation_from_abuse():
    lex, known = X.Lexicon({"idiot": 3.0}, {}), {}
    abuse = X.features("You are an idiot and you know it.", lex, known)
    quote = X.features('He wrote the word "idiot" in his report on language.', lex, known)
    aimed = X.features('She said "you idiot" to me.', lex, known)
    assert abuse[0] > 0 and abuse[7] == 0
    assert quote[0] == 0 and quote[7] > 0
    assert aimed[0] > 0 and aimed[7] == 0
    assert X.features(None, lex, known) == X.features("", lex, known) == [0.0] * X.FEATURES


def test_learn_and_score_with_odd_rows(spark):
    clean = [(i, f"a calm and friendly text about gardens number {i}") for i in range(40)]
    rude = [(100 + i, f"what a scoundrel you are, number {i}") for i in range(20)]
    docs = documents(spark, clean + rude + [(300, None), (301, ""), (302, "SC0UNDREL!! " * 50_000), (302, "repeated"), (None, "no id")])
    labels = spark.createDataFrame([(i, 1, int(i >= 100)) for i, _ in clean + rude] + [(None, 1, 1), (300, 1, None), (7, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    lex, w = X.learn(docs, labels)
    out = X.score_toxicity(docs.withColumnRenamed("lang", "score"), lex, w)
    assert out.columns == ["doc_id", "source", "n_chars", "score", "predicted"]
    got = [(r["doc_id"], r["predicted"]) for r in out.collect()]
    assert all(p == (100 <= i < 200) for i, p in got if i is not None and i < 200)
    assert sorted(p for i, p in got if i in (300, 301, None)) == [0, 0, 0]
    assert sorted(p for i, p in got if i == 302) == [0, 1]
    empty = documents(spark, [])
    lex, w = X.learn(empty, labels.limit(0))
    assert X.score_toxicity(docs, lex, w).agg({"predicted": "max"}).first()[0] == 0
    assert X.score_toxicity(empty, lex, w).count() == 0


def test_query_held_out(spark):
    truth = {r["doc_id"]: r["toxic"] for r in read(SF, "labels")}
    got = queries.op5_toxicity(spark, SF).collect()
    assert len(got) == len(read(SF, "documents"))
    assert all(r["held_out"] == held_out(r["doc_id"]) and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    out = [(r["predicted"], truth[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in truth]
    found = sum(p for p, t in out if t) / sum(t for _, t in out)
    false = sum(p for p, t in out if not t) / sum(1 - t for _, t in out)
    assert found > 0.85 and false < 0.02
