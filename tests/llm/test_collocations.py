import random
import re
from collections import Counter, defaultdict

import numpy as np

from riskpanel.llm import collocations as C
from riskpanel.llm import queries
from tests.llm.helpers import UPPER, documents, read

SF = "/root/testdata/sf0.01"


def plain(docs, least=10, max_words=3, top=2000, percent=50):
    """{(lang, rank): (phrase, a, l, r, n, score)} of (text, lang) by counting everything."""
    counts, total = defaultdict(Counter), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(rb"[.,;:!?\x0A-\x0D]", (text or "").encode().translate(UPPER)):
            w = [x for x in re.split(rb"[ \t]+", piece) if x]
            total[lang] += len(w)
            for k in range(1, max_words + 1):
                counts[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = {}
    for lang, f in counts.items():
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        drop = {p[i:i + k] for p, a in found.items() for k in range(2, len(p)) for i in range(len(p) - k + 1)
                if 100 * a >= percent * f[p[i:i + k]]}
        rows = []
        for p, a in found.items():
            if p not in drop:
                score, _, l, r = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                rows.append((-score, -a, b" ".join(p), l, r))
        for rank, (s, a, p, l, r) in enumerate(sorted(rows)[:top], 1):
            out[lang, rank] = (p.decode(), -a, l, r, total[lang], -s)
    return out


def rows(df):
    return {(r["lang"], r["rank"]): (r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in df.collect()}


def test_query_equals_a_plain_version(spark):
    assert rows(queries.op11_collocations(spark, SF)) == plain([(r["text"], r["lang"]) for r in read(SF, "documents")])


def test_small_blocks_longer_phrases_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(C, "TRIE_PHRASES", 20)
    r = random.Random(3)
    words = ["A", "b", "Été", "c-d", "日本", "it's", "x\x00y", "a b", "e\x1cf", "."]
    docs = [("".join(r.choice(words) + r.choice([" ", "  ", "\t", " , ", "\n", "\x0b", " "]) for _ in range(400)), r.choice(["en", None, "und", "d"]))
            for _ in range(25)]
    docs += [(None, "en"), ("", None), ("a b a b a b " * 20_000, "hot"), ("solo", "one"), (" . , ", "en"), (docs[0][0], docs[0][1])]
    df = documents(spark, [(i, t, l) for i, (t, l) in enumerate(docs)]).withColumnRenamed("source", "phrase").withColumnRenamed("n_chars", "w")
    assert rows(C.mine_phrases(df, least=4, max_words=4, top=50)) == plain(docs, 4, 4, 50)
    assert rows(C.mine_phrases(df, least=3, max_words=2, top=7)) == plain(docs, 3, 2, 7)


def test_empty_tables(spark):
    assert C.mine_phrases(documents(spark, [])).count() == 0
    assert C.mine_phrases(documents(spark, [(1, None), (2, "a b"), (3, "")])).count() == 0


def test_equal_hashes_take_another_seed(spark, monkeypatch):
    docs = documents(spark, [(1, "a b c a b", "en"), (2, "a b", "en")])
    import riskpanel.llm.collocations as module
    first = module.encoded_corpus
    seeds = []

    def clashing(df, seed):
        seeds.append(seed)
        got = first(df, seed)
        return got.withColumn("hashes", module.F.transform("hashes", lambda x: x * 0)) if seed == 0 else got

    monkeypatch.setattr(module, "encoded_corpus", clashing)
    assert rows(C.mine_phrases(docs, least=2, max_words=2)) == plain([("a b c a b", "en"), ("a b", "en")], 2, 2)
    assert seeds == [0, 1]


def test_trie_counts_like_a_dictionary():
    r = np.random.Generator(np.random.PCG64(4))
    words = r.integers(0, 2 ** 63, 400, dtype=np.uint64) * np.uint64(2)
    for k in (1, 2, 3):
        picks = np.unique(np.concatenate([r.integers(0, 60 if k > 1 else 400, (3000, k)), np.stack([np.zeros(400, int)] * (k - 1) + [np.arange(400)], axis=1)]), axis=0)
        lang_of = r.integers(0, 2, len(picks)).astype(np.int32)
        t = C.Trie(["x", "y"], words[picks], lang_of)
        assert len(set(t.state_of.tolist())) == len(picks)
        codes = r.integers(0, 60 if k > 1 else 401, 30_000).astype(np.int32)
        want, state = Counter(), {(lang_of[i], *p): t.state_of[i] for i, p in enumerate(picks.tolist())}
        for i in range(len(codes) - k + 1):
            p = (1, *(codes[i:i + k] - 1).tolist())
            if p in state:
                want[state[p]] += 1
        assert Counter(t.advance("y", words, codes, k).tolist()) == want and sum(want.values()) > 50
        assert len(t.advance("z", words, codes, k)) == 0


def test_a_level_takes_the_same_passes_however_many_candidates(spark, monkeypatch):
    r = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    docs = [(" ".join(r.choices(words, [1 / (i + 1) for i in range(60)], k=600)), r.choice(["en", "d"])) for _ in range(24)]
    df = documents(spark, [(i, t, l) for i, (t, l) in enumerate(docs)]).repartition(8)
    tables, common, write, pack = [], [], C.written, getattr(C, "packed_trie", None)

    def packed(found):
        common.append(found.count())
        return pack(found)

    monkeypatch.setattr(C, "written", lambda df, name: (tables.append(name), write(df, name))[1])
    monkeypatch.setattr(C, "packed_trie", packed, raising=False)
    monkeypatch.setattr(C, "HELD", 200)
    monkeypatch.setattr(C, "BATCH_BYTES", 500)
    want = plain(docs, 4)
    assert rows(C.mine_phrases(df, least=4)) == want
    at_once, whole = len(tables), list(common)
    tables.clear(), common.clear()
    monkeypatch.setattr(C, "TRIE_PHRASES", 50)
    assert rows(C.mine_phrases(df, least=4)) == want
    assert len(tables) <= at_once
    # first all in the trie that every task has, then a few; the others are counted where they are dealt
    assert whole[0] > 500 and 0 < common[0] <= 50


def test_phrases_dealt_with_equal_hashes_are_told_apart():
    two = np.array([[1, 2], [3, 4], [1, 2], [3, 4], [5, 6]], np.uint64)
    got, h, times = C._summed("x", two, np.array([7, 7, 7, 7, 8], np.uint64), np.array([1, 10, 100, 1000, 5], np.uint64))
    assert sorted(zip(got.tolist(), h.tolist(), times.tolist())) == [([1, 2], 7, 101), ([3, 4], 7, 1010), ([5, 6], 8, 5)]
    t = C.Trie(["x"], got, np.zeros(3, np.int32))
    place, state = t.states("x", np.array([[5, 6], [1, 4], [1, 2], [9, 9]], np.uint64))
    assert [p // 2 for p in place.tolist()] == [0, 2]
    assert state.tolist() == [t.state_of[got.tolist().index(p)] for p in ([5, 6], [1, 2])]
    assert len(t.states("y", got)[0]) == 0


def test_bit_maps_grow_and_hold_every_hash(spark):
    h = np.random.Generator(np.random.PCG64(9)).integers(0, 2 ** 63, 20_000).astype(np.uint64) * np.uint64(2)
    df = spark.createDataFrame([(int(x),) for x in h.view(np.int64)], "h long")
    small, large = C.bit_map(df, len(h)), C.bit_map(df, 3_000_000)
    assert len(large) == 2 * len(small) and len(C.bit_map(df, 10 ** 9)) == 4 * len(small)
    for parts in (small, large):
        bits = C._unpacked(parts)
        assert C._has(bits, h).all() and C._has(bits, h + np.uint64(1 << 40)).mean() < 0.01
    assert not C._has(C._unpacked(C.bit_map(df.limit(0), 0)), h).any()
