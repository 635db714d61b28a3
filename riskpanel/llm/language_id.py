"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. An n-gram's vector binds its
letters: the vectors, permuted by their place, are multiplied. A document's
vector bundles (sums) those of its n-grams, each with the square root of its
count, so that a line repeated many times does not drown the rest; a language's
prototype bundles its training documents, and a document gets the language whose
prototype has the largest cosine with its own vector.

Prototypes are sums, so learning is one pass with partial sums per task. A
document's inner products are taken per distinct n-gram of a batch.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskpanel.llm.common import fresh, shipped

DIM = 1024
GRAM = 3
SEED = 20_011
#: Code points handled at once, and n-grams whose vectors are held at once.
CHUNK, SLICE = 400_000, 16_384


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """True for each code point that is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


@lru_cache(maxsize=8192)
def letter_vector(code: int, dim: int) -> np.ndarray:
    """The random +1 / -1 vector of a code point; the same in every process."""
    return (np.random.Generator(np.random.PCG64([SEED, code])).integers(0, 2, dim, dtype=np.int8) * 2 - 1)


def gram_vectors(grams: np.ndarray, dim: int) -> np.ndarray:
    """Bound vectors of n-grams (rows of code points): place i is permuted i times."""
    codes, at = np.unique(grams, return_inverse=True)
    at = at.reshape(grams.shape)
    base = np.stack([letter_vector(int(c), dim) for c in codes])
    out = np.ones((len(grams), dim), np.int8)
    for i in range(grams.shape[1]):
        out *= np.roll(base, grams.shape[1] - 1 - i, axis=1)[at[:, i]]
    return out


def _ranks(values: np.ndarray, below: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values, ascending, and each value's index among them."""
    if below > 1 << 24:
        return np.unique(values, return_inverse=True)
    seen = np.zeros(below, bool)
    seen[values] = True
    distinct = np.flatnonzero(seen)
    rank = np.zeros(below, np.int64)
    rank[distinct] = np.arange(len(distinct))
    return distinct, rank[values]


def count_grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(doc, gram index, count) triples in order of doc, and the distinct n-grams.

    Letters are lower-cased; every run of other characters is one space, and a
    text begins and ends with one. Texts without a letter have no n-grams.
    """
    empty = np.zeros(0, np.int64)
    none = (empty, empty, empty, np.zeros((0, GRAM), np.int64))
    low = [f" {t.lower()} " for t in texts]
    length = np.fromiter(map(len, low), np.int64, len(low))
    code = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    doc = np.repeat(np.arange(len(low)), length)
    letter = _letters()[code]
    keep = letter.copy()
    keep[1:] |= letter[:-1] & (doc[1:] == doc[:-1])  # the first character after a letter
    first = np.concatenate([[0], np.cumsum(length)[:-1]])
    keep[first] = True
    code, doc = np.where(letter, code, 32)[keep], doc[keep]
    if len(code) < GRAM:
        return none
    alphabet, sym = _ranks(code.astype(np.int64), 0x110000)
    size = len(alphabet)
    whole = doc[GRAM - 1:] == doc[:len(doc) - GRAM + 1]
    gram = np.zeros(len(sym) - GRAM + 1, np.int64)
    for i in range(GRAM):
        gram = gram * size + sym[i:len(sym) - GRAM + 1 + i]
    gram, of = gram[whole], doc[:len(whole)][whole]
    if not len(gram):
        return none
    grams, index = _ranks(gram, size ** GRAM)
    pair = of * len(grams) + index
    if len(texts) * len(grams) <= 1 << 23:  # count in a table; else, for huge alphabets, by sorting
        table = np.bincount(pair, minlength=len(texts) * len(grams))
        pair = np.flatnonzero(table)
        n = table[pair]
    else:
        pair, n = np.unique(pair, return_counts=True)
    of, index = pair // len(grams), pair % len(grams)
    places = [alphabet[grams // size ** (GRAM - 1 - i) % size] for i in range(GRAM)]
    return of, index, n, np.stack(places, axis=1).astype(np.int64)


def _chunks(texts: list[str | None]):
    """(index list, text list) of about CHUNK code points; longer texts are left out (see ``long_counts``)."""
    at, part, held = [], [], 0
    for i, t in enumerate(texts):
        if not t or len(t) > CHUNK:
            continue
        at.append(i)
        part.append(t)
        held += len(t)
        if held >= CHUNK:
            yield at, part
            at, part, held = [], [], 0
    if part:
        yield at, part


def long_counts(text: str, chunk: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams, counts) of a whole text, read in parts: as ``count_grams``, in memory that does not grow with the text.

    Parts end at a character that is no letter where there is one among the next
    ``chunk``; the last GRAM - 1 characters of a part are read again with the next.
    """
    chunk = chunk or CHUNK
    grams, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    before, start = np.array([32], np.int64), 0
    while start < len(text):
        stop = min(len(text), start + chunk)
        while stop < min(len(text), start + 2 * chunk) and text[stop - 1].isalpha():
            stop += 1
        code = np.frombuffer(text[start:stop].lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        letter = _letters()[code]
        code = np.concatenate([before, np.where(letter, code, 32), [32] if stop == len(text) else []]).astype(np.int64)
        code = code[np.concatenate([[True], (code[1:] != 32) | (code[:-1] != 32)])]  # one space for each run
        n = len(code) - GRAM + 1
        if n > 0:
            packed = np.zeros(n, np.int64)
            for i in range(GRAM):
                packed = packed << 21 | code[i:n + i]
            new, times = np.unique(packed, return_counts=True)
            grams, back = np.unique(np.concatenate([grams, new]), return_inverse=True)
            counts = np.bincount(back, np.concatenate([counts, times]), len(grams)).astype(np.int64)
        before, start = code[max(0, len(code) - GRAM + 1):], stop
    places = [grams >> 21 * (GRAM - 1 - i) & (1 << 21) - 1 for i in range(GRAM)]
    known = np.any([_letters()[x] for x in places], axis=0) if len(grams) else np.zeros(0, bool)
    return np.stack(places, axis=1)[known], counts[known]


def bundle(grams: np.ndarray, weight: np.ndarray, dim: int) -> np.ndarray:
    """Weighted sum of the n-grams' vectors, a slice of them at a time."""
    out = np.zeros(dim)
    for a in range(0, len(grams), SLICE):
        out += weight[a:a + SLICE].astype(np.float32) @ gram_vectors(grams[a:a + SLICE], dim).astype(np.float32)
    return out


def _doc_vectors(texts: list[str | None], dim: int):
    """(row, bundled vector) of every text with a letter: square roots of the n-gram counts of the whole text."""
    for i, t in enumerate(texts):
        if t and len(t) > CHUNK:
            grams, n = long_counts(t)
            if len(grams):
                yield i, bundle(grams, np.sqrt(n), dim)
    for at, part in _chunks(texts):
        of, index, n, grams = count_grams(part)
        if not len(of):
            continue
        small = len(grams) <= SLICE  # vectors that all texts of the part share
        hv = gram_vectors(grams, dim) if small else None
        start = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
        for s, e in zip(start, np.append(start[1:], len(of))):
            w, own = np.sqrt(n[s:e]), index[s:e]
            yield at[of[s]], w.astype(np.float32) @ hv[own].astype(np.float32) if small else bundle(grams[own], w, dim)


def learn_prototypes(train: DataFrame, dim: int = DIM) -> DataFrame:
    """(lang, position, value): bundled vectors of the languages, from rows (text, lang).

    Rows with a null text or lang teach nothing.
    """
    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            texts, langs = b.column(0).to_pylist(), b.column(1).to_pylist()
            for i, t in enumerate(texts):
                if t and len(t) > CHUNK:
                    grams, n = long_counts(t)
                    if len(grams):
                        sums[langs[i]] = sums.get(langs[i], 0) + bundle(grams, np.sqrt(n), dim)
            for at, part in _chunks(texts):
                of, index, n, grams = count_grams(part)
                lang_of = np.array([langs[i] for i in at], object)
                for lang in set(lang_of) if len(of) else ():
                    mine = (lang_of == lang)[of]
                    weight = np.bincount(index[mine], np.sqrt(n[mine]), len(grams))
                    used = np.flatnonzero(weight)
                    if len(used):
                        sums[lang] = sums.get(lang, 0) + bundle(grams[used], weight[used], dim)
        for lang, v in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * dim), pa.array(range(dim), pa.int32()),
                                              pa.array(v)], ["lang", "position", "value"])

    rows = train.filter(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang")
    return (shipped(rows).mapInArrow(run, "lang string, position int, value double")
            .groupBy("lang", "position").agg(F.sum("value").alias("value")))


def collect_prototypes(prototypes: DataFrame, dim: int = DIM) -> tuple[list[str], np.ndarray]:
    """Languages (sorted) and their unit vectors; one row of ``dim`` numbers per language."""
    rows = prototypes.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("position", "value"))).alias("v"))
    got = sorted((r["lang"], [x["value"] for x in r["v"]]) for r in rows.collect())
    m = np.array([v for _, v in got], np.float64).reshape(len(got), dim)
    unit = m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)
    return [k for k, _ in got], unit


def predict_language(docs: DataFrame, langs: list[str], prototypes: np.ndarray, text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with lang_pred and score (cosine with that prototype, 0 to 1).

    Ties go to the language first by code point. Null texts, texts without a
    letter, and any text if nothing was learned: 'und' with score 0. Input
    columns named lang_pred or score are replaced; rows repeat as in the input.
    """
    dim = prototypes.shape[1] if len(langs) else DIM
    proto = prototypes.astype(np.float32)
    keep = [c for c in docs.columns if c not in (text, "lang_pred", "score")]

    def score(texts):
        inner, norm2 = np.zeros((len(texts), len(langs))), np.zeros(len(texts))
        for i, v in _doc_vectors(texts, dim):
            inner[i], norm2[i] = proto @ v, v @ v
        return inner / np.maximum(np.sqrt(norm2), 1e-12)[:, None], norm2 > 0

    def run(batches):
        for b in batches:
            cos, known = score(b.column(0).to_pylist())
            if langs:
                best = cos.argmax(axis=1)
                pred = [langs[k] if ok else "und" for k, ok in zip(best, known)]
                s = np.where(known, cos[np.arange(len(cos)), best].clip(0, 1), 0.0)
            else:
                pred, s = ["und"] * b.num_rows, np.zeros(b.num_rows)
            yield pa.RecordBatch.from_arrays(
                [*[b.column(i + 1) for i in range(len(keep))], pa.array(pred, pa.string()), pa.array(s)],
                [*keep, "lang_pred", "score"])

    cols = docs.select(F.col(text).cast("string").alias(fresh("__text", keep)), *[F.col(f"`{c}`") for c in keep])
    schema = T.StructType([*cols.schema.fields[1:], T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    return shipped(cols).mapInArrow(run, schema)
