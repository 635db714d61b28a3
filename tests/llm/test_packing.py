import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from riskpanel.llm import packing as P
from riskpanel.llm import queries
from riskpanel.llm import word_encoder as W
from riskpanel.llm.common import written
from tests.llm.helpers import documents, read

SF = "/root/testdata/sf0.01"
PATH = public_tokenizers.path("word_bpe_49k.json")


def encode(texts):
    t = Tokenizer.from_file(PATH)
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def naive(lengths, window):
    """Used tokens per sequence by best fit decreasing over single pieces."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [(r, i) for i, r in enumerate(rooms) if r >= n]
        if fits:
            rooms[min(fits)[1]] -= n
        else:
            rooms.append(window - n)
    return sorted(window - r for r in rooms)


def test_plan_equals_best_fit_decreasing_of_single_pieces():
    r = random.Random(1)
    for window in (10, 64, 100):
        for _ in range(30):
            lengths = [r.choice([r.randrange(1, window + 1), 7]) for _ in range(r.randrange(1, 300))]
            used, ranks, at = defaultdict(int), defaultdict(set), defaultdict(list)
            for n, a, b, first, offset in P.plan_best_fit(Counter(lengths), window):
                for k in range(a, b):
                    assert k not in ranks[n]
                    ranks[n].add(k)
                    used[first + k - a] += n
                    at[first + k - a].append((offset, n))
            assert {n: len(v) for n, v in ranks.items()} == Counter(lengths)
            assert sorted(used) == list(range(len(used)))
            assert sorted(used.values()) == naive(lengths, window)
            for pieces in at.values():
                end = 0
                for o, n in sorted(pieces):
                    assert o == end
                    end += n


def test_tree_finds_the_tightest():
    tree, have, r = P.CapacityTree(50), Counter(), random.Random(2)
    for _ in range(2000):
        c = r.randrange(51)
        step = -1 if have[c] and r.random() < 0.6 else 1
        have[c] += step
        tree.add(c, step)
        need = r.randrange(51)
        assert tree.tightest(need) == min((k for k, n in have.items() if n and k >= need), default=None)


def test_ids_equal_the_tokenizers(monkeypatch):
    texts = ["Hello, World! It's  a test.", "don't 's 're 'll", "a b c\u0085d", "<|endoftext|> x<|startoftext|>y", "ÉTÉ Ǆ ΣΑΣ ΟΔΟΣ",
             "a ́b é é", "tab\tnew\nline\x0b\x0c\r.", "!!! ?? ... ) a).", "(abc) [été]. ~x~ `y` a_b a^b", '"ça" ÷ a÷ ø- -ø ý ÿ. ß!', "日本語 テキスト", "\x1c\x1d a\x1fb", "", "x" * 3000, "１２ ½ ﬁ ẞ İ",
             "a=\u0338b .\u0301x it's.'s x'.s 'll…, …,a (a)b-c --'s--", "<|x A,B <| c", "1a2b-3 4.5,6é7", "\x00a.\x00b", "#é# é#a ß-ß"]
    texts += [r["text"] for r in read(SF, "documents")[:200]]
    monkeypatch.setattr(W, "CACHED_WORDS", 500)
    encoder = W.WordEncoder(PATH)
    for _ in range(2):
        for at in range(0, len(texts), 7):
            part = texts[at:at + 7]
            got = [np.frombuffer(x, "<u4").tolist() for x in encoder.encode([t.encode() for t in part])]
            assert got == encode(part), part


def test_pieces_and_places_of_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "word " * 200), (3, "word " * 200), (None, "no id"), (4, "a b c"), (5, "x y " * 40_000)]
    df = documents(spark, docs).withColumnRenamed("lang", "offset").withColumnRenamed("source", "length")
    table = written(df, "test-pack")
    got = P.pack(df, PATH, window=64).collect()
    from_files = P.pack(table, PATH, window=64).collect()  # a scan's rows are named by file and position
    assert Counter((r["doc_id"], r["start"], bytes(r["ids"])) for r in got) == Counter((r["doc_id"], r["start"], bytes(r["ids"])) for r in from_files)
    assert P.pack(documents(spark, []), PATH).count() == 0
    want = Counter(tuple(ids + [2]) for ids in encode([t for _, t in docs]))
    per_seq, back, lone = defaultdict(list), defaultdict(list), Counter()
    for r in got:
        ids = np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        assert len(ids) == r["length"] <= 64
        per_seq[r["sequence_id"]].append((r["offset"], r["length"]))
        back[r["doc_id"]].append((r["start"], tuple(ids), r["doc_tokens"]))
    assert sorted(per_seq) == list(range(len(per_seq)))
    for v in per_seq.values():
        end = 0
        for o, n in sorted(v):
            assert o == end
            end += n
        assert end <= 64
    for i, v in back.items():
        times = 2 if i == 3 else 1
        text = [x for s, x, _ in sorted(v)][::times]
        lone[tuple(sum(text, ()))] += times
        assert v[0][2] == sum(map(len, text))
    assert lone == want


def test_query_round_trip(spark):
    docs = read(SF, "documents")
    want = {r["doc_id"]: np.array(ids + [2], "<u4") for r, ids in zip(docs, encode([r["text"] for r in docs]))}
    got, used = defaultdict(list), Counter()
    for r in queries.op10_packing(spark, SF).collect():
        got[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
        used[r["sequence_id"]] += r["length"]
    assert got.keys() == want.keys() and max(used.values()) <= 4096
    for i, pieces in got.items():
        end = 0
        for start, n, crc, total in sorted(pieces):
            assert start == end and total == len(want[i]) and crc == zlib.crc32(want[i][start:start + n].tobytes())
            end += n
        assert end == len(want[i])
    assert sum(used.values()) > 0.995 * 4096 * len(used)


def test_special_strings_count_in_their_own_spelling():
    texts = ["<|ENDOFTEXT|>", "Ab <|EndOfText|>x C", "<|endoftext|>", "Ab<|endoftext|>CD É<|StartOfText|>Ü <|startoftext|>",
             "<|endoftext|>", "A <| B |> <|ENDOFTEXT|>"]
    got = W.WordEncoder(PATH).encode([t.encode() for t in texts])
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == encode(texts)


def test_remembered_words_are_bounded_and_frequent_ones_stay(monkeypatch):
    monkeypatch.setattr(W, "CACHED_WORDS", 100)
    encoder, learned = W.WordEncoder(PATH), Counter()
    learn = encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda new: (learned.update(new), learn(new)))
    texts = ["often " + " ".join(f"x{i}y{j}" for j in range(20)) for i in range(30)]
    for t in texts:
        got = encoder.encode([t.encode()])
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == encode([t])
        assert len(encoder.words) + len(encoder.older) <= 100
    assert learned[b"often"] == 1
    wide = " ".join(f"w{i}" for i in range(300))  # more words than are remembered
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode([wide.encode()])] == encode([wide])


def test_cutting_needs_few_bytes_beside_the_text():
    text = "Ab, c\u00e9 (d1) it's\n" * 50_000
    column = pa.array([text, None, "", text + "<|"])
    W._cuts(column.slice(0, 1))
    tracemalloc.start()
    words, firsts = W._cuts(column.slice(0, 3))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 * len(text.encode()) and b"".join(words.to_pylist()) == text.lower().encode() and firsts[2] == firsts[3] == len(words)
    words, _ = W._cuts(column.slice(3, 1))
    assert b"".join(words.to_pylist()) == (text + "<|").encode()


def test_a_worker_remembers_two_hundred_thousand_words_in_few_bytes(monkeypatch):
    encoder, learned = W.WordEncoder(PATH), Counter()
    learn = encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda new: (learned.update(new), learn(new)))
    letters = "abcdefghijklmnopqrst"
    words = [a + b + c + d + e for a in letters for b in letters for c in letters for d in letters for e in "ée"][:240_000]
    first, second = " ".join(words[:120_000]), " ".join(words[120_000:])
    before = encoder.encode([first.encode()])
    encoder.encode([second.encode()])
    assert encoder.encode([first.encode(), b"", first.encode()]) == [*before, b"", *before]
    assert max(learned.values()) == 1 and len(encoder.words) == len(words) + 1
    assert sum(x.nbytes for x in (encoder.words, encoder.ids, encoder.older, encoder.older_ids)) < 48 * len(words)
    ids = np.frombuffer(before[0], "<u4")
    assert ids.tolist() == encode([first])[0]
