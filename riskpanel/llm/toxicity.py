"""Toxicity from a learned lexicon, matched with misspellings and read in context.

The lexicon is learned from labelled documents: words, and beginnings of
words, that toxic documents have far more often. It is kept as a trie. Words
are matched by intersecting the trie with Levenshtein automata: the states
reached by all terms at once (trie node, edits so far) form one automaton that
is made deterministic as words are read, so a word costs one step per letter.
A window around each match separates quotation (the term stands inside quote
marks, near a word of reporting, and nobody is addressed) from abuse. Counts
of matches by kind feed a logistic model fitted on the same labelled sample.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskpanel.llm.common import fresh, shipped, written

#: Labelled rows the model is fitted on, at most (chosen by a hash of the id).
SAMPLE = 20_000
#: Toxic documents that a term of the lexicon must occur in.
SUPPORT = 8
#: A term is matched with misspellings if at most this share of clean documents has a near miss of it.
NEAR_MISSES = 0.003
#: Weight of a match lost with each edit.
EDIT_LOSS = 0.15
PREFIX = (4, 5, 6, 7)
WINDOW = 8
QUOTES = "\"“”„«»‟"
STRIP = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + QUOTES + "‘’‚–—…¡¿§"
REPORTING = frozenset("said says say called calls quote quoted wrote writes word term phrase insult slur dit mot "
                      "sagte wort dijo palabra".split())
ADDRESS = frozenset("you your you're youre u ur yourself du dein deine ihr tu toi vous votre tú usted ustedes".split())
KNOWN_WORDS = 300_000


def core(token: str) -> str:
    """A token without marks at both ends."""
    return token.strip(STRIP)


def allowed_edits(term: str) -> int:
    """Edits up to which a term is recognised: short words are left exact."""
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Lexicon:
    """Trie of whole terms and word beginnings, read through a lazily built Levenshtein automaton."""

    def __init__(self, words: dict[str, float], beginnings: dict[str, float], exact: frozenset[str] = frozenset()):
        """``exact``: the words that are matched without misspellings."""
        self.words, self.beginnings = words, beginnings
        self.child: list[dict[str, int]] = [{}]
        self.term: list[float | None] = [None]
        self.edits: list[int] = [0]
        self.reach: list[int] = [0]  # most edits any term below a node allows
        self.beginning: list[float | None] = [None]
        self.name: list[str | None] = [None]
        for w, weight in words.items():
            at, k = self._path(w), 0 if w in exact else allowed_edits(w)
            self.term[at[-1]], self.edits[at[-1]], self.name[at[-1]] = weight, k, w
            for n in at:
                self.reach[n] = max(self.reach[n], k)
        for w, weight in beginnings.items():
            self.beginning[self._path(w)[-1]] = weight
        self.letters = {c for kids in self.child for c in kids}
        self.states: dict[tuple, int] = {}
        self.sets: list[tuple] = []
        self.step: list[dict[str, int]] = []
        self.accept: list[tuple | None] = []
        self.start = self._state(self._close({0: 0}))

    def _path(self, word: str) -> list[int]:
        at = [0]
        for c in word:
            nxt = self.child[at[-1]].get(c)
            if nxt is None:
                nxt = len(self.child)
                self.child[at[-1]][c] = nxt
                self.child.append({})
                self.term.append(None)
                self.edits.append(0)
                self.reach.append(0)
                self.beginning.append(None)
                self.name.append(None)
            at.append(nxt)
        return at

    def _close(self, nodes: dict[int, int]) -> dict[int, int]:
        """Add the nodes reached by leaving out letters of a term."""
        todo = list(nodes)
        while todo:
            n = todo.pop()
            for kid in self.child[n].values():
                e = nodes[n] + 1
                if e <= self.reach[kid] and e < nodes.get(kid, 99):
                    nodes[kid] = e
                    todo.append(kid)
        return nodes

    def _state(self, nodes: dict[int, int]) -> int:
        key = tuple(sorted(nodes.items()))
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key)
            self.step.append({})
            best = [(e, -self.term[n], self.name[n]) for n, e in key if self.term[n] is not None and e <= self.edits[n]]
            self.accept.append(min(best) if best else None)
        return self.states[key]

    def _move(self, state: int, c: str) -> int:
        nodes: dict[int, int] = {}

        def put(n, e):
            if e <= self.reach[n] or e == 0:
                nodes[n] = min(e, nodes.get(n, 99))

        for n, e in self.sets[state]:
            put(n, e + 1)  # a letter too many
            for letter, kid in self.child[n].items():
                put(kid, e if letter == c else e + 1)  # the right letter, or another
        return self._state(self._close(nodes))

    def read(self, word: str) -> tuple[int, float, str] | None:
        """(kind, weight, term) of a word: kind 1 exact term, 2 misspelled term (less
        weight for each edit), 3 beginning; None if nothing matches."""
        s = self.start
        for c in word[:64]:
            c = c if c in self.letters else "\0"
            nxt = self.step[s].get(c)
            if nxt is None:
                nxt = self.step[s][c] = self._move(s, c)
            s = nxt
            if not self.sets[s]:
                break
        got = self.accept[s] if len(word) <= 64 else None
        if got is not None:
            return (2 if got[0] else 1, -got[1] * (1 - EDIT_LOSS * got[0]), got[2])
        n, best = 0, None
        for c in word:
            n = self.child[n].get(c)
            if n is None:
                break
            if self.beginning[n] is not None:
                best = max(best or 0.0, self.beginning[n])
        return (3, best, "") if best is not None else None


FEATURES = 8


def features(text: str | None, lexicon: Lexicon, known: dict) -> list[float]:
    """What the matches of one text amount to: the largest weight of a term, the
    sum over different terms and their number, the rate of matches; the same for
    word beginnings; and matches that are quoted, apart from all others."""
    tokens = (text or "").lower().split()
    new = set(tokens).difference(known)
    if new:
        if len(known) + len(new) > KNOWN_WORDS:
            known.clear()
            new = set(tokens)
        for t in new:
            w = core(t)
            known[t] = lexicon.read(w) if w else None
    terms: dict[str, float] = {}
    hits = starts = quoted = 0
    start_weight = 0.0
    found = [known[t] for t in tokens]
    if any(found):
        inside, run = [], 0  # whether an odd number of quote marks stand before the token's end
        marked = any(q in (text or "") for q in QUOTES)
        if marked:
            for t in tokens:
                marks = sum(t.count(q) for q in QUOTES)
                inside.append(run % 2 == 1 or marks > 0)
                run += marks
        for i, hit in enumerate(found):
            if hit is None:
                continue
            if marked and inside[i]:
                near = [core(t) for t in tokens[max(0, i - WINDOW):i + WINDOW + 1]]
                if not REPORTING.isdisjoint(near) and ADDRESS.isdisjoint(near):
                    quoted += 1
                    continue
            if hit[0] == 3:
                starts += 1
                start_weight += hit[1]
            else:
                hits += 1
                terms[hit[2]] = max(hit[1], terms.get(hit[2], 0.0))
    total = max(1, len(tokens))
    return [max(terms.values(), default=0.0), math.log1p(sum(terms.values())), math.log1p(len(terms)),
            min(5.0, 100.0 * hits / total), math.log1p(starts), min(5.0, 100.0 * starts / total),
            min(5.0, 20.0 * start_weight / total), math.log1p(quoted)]


def _terms_of(text: str) -> set[str]:
    """What a document may contribute to the lexicon: its words, and word beginnings marked with *."""
    out = set()
    for t in set(text.lower().split()):
        w = core(t)
        if len(w) >= 3:
            out.add(w)
            out.update(w[:k] + "*" for k in PREFIX if len(w) > k)
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> DataFrame:
    """(text, toxic) of at most ``rows`` labelled documents, chosen by a hash of the id.

    Labels other than 0 and 1 and null ids are left out; of several labels of one
    document the largest counts, of several texts of one id the least.
    """
    docs = docs.select("doc_id", "text")
    few = (labels.filter("doc_id is not null and toxic in (0, 1)").groupBy("doc_id")
           .agg(F.max("toxic").cast("int").alias("toxic"))
           .orderBy(F.xxhash64(F.lit("toxicity"), "doc_id"), "doc_id").limit(rows))  # bounded: can be broadcast
    return written(docs.join(F.broadcast(few.withColumnRenamed("doc_id", "__id")), docs["doc_id"] == F.col("__id"))
                   .groupBy("__id", "toxic").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
                   .repartition(32, "__id").select("text", "toxic"), "tox-sample")


def learn_lexicon(sample: DataFrame, support: int = SUPPORT) -> Lexicon:
    """All terms with enough evidence for toxic documents in (text, toxic) rows; the bounded sample bounds them."""
    def run(batches):
        n = [Counter(), Counter()]
        for b in batches:
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                n[y].update(_terms_of(t))
        # what occurs in no toxic document of the task still counts: clean counts are needed for all
        every = list(n[0].keys() | n[1].keys())
        for i in range(0, len(every), 50_000):
            part = every[i:i + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array([n[1][t] for t in part], pa.int64()),
                                              pa.array([n[0][t] for t in part], pa.int64())],
                                             ["term", "toxic", "clean"])

    counts = sample.groupBy("toxic").count().collect()  # two rows
    total = {r["toxic"]: r["count"] for r in counts}
    bad, good = total.get(1, 0), total.get(0, 0)
    stats = shipped(sample).mapInArrow(run, "term string, toxic long, clean long").groupBy("term") \
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    weight = F.log((F.col("toxic") + 0.5) / (bad + 1.0)) - F.log((F.col("clean") + 0.5) / (good + 1.0))
    best = (stats.filter(F.col("toxic") >= support).withColumn("weight", weight).filter("weight > 1.5")
            .orderBy("term").collect())
    words = {r["term"]: r["weight"] for r in best if not r["term"].endswith("*")}
    # a beginning that only repeats a whole term adds nothing; words come in order, so those with a beginning are neighbours
    ordered, holders = sorted(words), {r["term"]: r["toxic"] for r in best}
    beginnings = {}
    for r in best:
        if r["term"].endswith("*"):
            start = r["term"][:-1]
            same = [holders[w] for w in ordered[bisect_left(ordered, start):bisect_left(ordered, start + "\U0010ffff")]]
            if not same or r["toxic"] > 1.2 * max(same):
                beginnings[start] = r["weight"]
    return Lexicon(words, beginnings, _noisy_terms(sample, Lexicon(words, beginnings), good))


def _noisy_terms(sample: DataFrame, lexicon: Lexicon, clean: int) -> frozenset[str]:
    """The terms of which too many clean documents have a near miss: their
    neighbours are ordinary words, so they are matched exactly."""
    def run(batches):
        known: dict = {}
        near = Counter()
        for b in batches:
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if y == 0:
                    tokens = set(t.lower().split())
                    for x in tokens.difference(known):
                        w = core(x)
                        hit = lexicon.read(w) if w else None
                        known[x] = hit[2] if hit and hit[0] == 2 else ""
                    near.update({known[x] for x in tokens} - {""})
        yield pa.RecordBatch.from_arrays([pa.array(list(near), pa.string()), pa.array(list(near.values()), pa.int64())],
                                         ["term", "n"])

    counts = shipped(sample).mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return frozenset(r["term"] for r in counts.filter(F.col("n") > NEAR_MISSES * clean).collect())  # lexicon terms


def _featured(df: DataFrame, lexicon: Lexicon, column: str, keep: list[str], score) -> DataFrame:
    """``keep`` columns and the result of ``score`` (a list of doubles) for each row's text."""
    kept = df.select(*[F.col(f"`{c}`") for c in keep])
    read = fresh("__text", keep)
    schema = T.StructType([*kept.schema.fields, T.StructField(column, T.ArrayType(T.DoubleType()))])

    def run(batches):
        known: dict = {}
        for b in batches:
            out = [score(features(t.as_py(), lexicon, known)) for t in b.column(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(out, pa.list_(pa.float64()))], [*keep, column])

    return shipped(df).select(*[F.col(f"`{c}`") for c in keep], F.col("text").cast("string").alias(read)) \
        .mapInArrow(run, schema)


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Ridge logistic regression by Newton's method; the last coefficient is the constant."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p) + 1e-9)[:, None]).T @ a + np.diag(penalty)
        step = np.linalg.solve(h, a.T @ (y - p) - penalty * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def learn(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> tuple[Lexicon, np.ndarray]:
    """Lexicon and coefficients from at most ``rows`` labelled documents.

    Without labelled documents of both kinds everything scores 0.
    """
    sample = labelled_sample(docs, labels, rows)
    lexicon = learn_lexicon(sample)
    got = _featured(sample, lexicon, "x", ["toxic"], lambda f: f).collect()  # at most ``rows`` short rows
    y = np.array([r["toxic"] for r in got], float)
    if len(set(y)) < 2:
        return lexicon, np.append(np.zeros(FEATURES), -30.0)
    return lexicon, fit(np.array([r["x"] for r in got]), y)


def score_toxicity(docs: DataFrame, lexicon: Lexicon, w: np.ndarray, with_text: bool = False) -> DataFrame:
    """The input's columns, text only if asked for, with score (0 to 1) and predicted (1 if score >= 0.5).

    Null and empty texts get the score of a text without matches. Rows repeat as
    in the input; input columns named score or predicted are replaced.
    """
    keep = [c for c in docs.columns if c not in ("score", "predicted") and (with_text or c != "text")]
    result = fresh("__s", keep)
    coef, const = [float(v) for v in w[:-1]], float(w[-1])

    def score(f):
        z = const + sum(a * b for a, b in zip(coef, f))
        return [1 / (1 + math.exp(-max(-30.0, min(30.0, z))))]

    out = _featured(docs, lexicon, result, keep, score)
    return out.withColumn("score", F.col(result)[0]).drop(result) \
        .withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
