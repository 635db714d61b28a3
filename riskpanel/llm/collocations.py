"""Phrase collocations by levels of candidates, counted with broadcast tries.

One pass cuts the texts into words and writes them as numbers (batches of one
language, each with its own small dictionary); all later passes read these.
Counting goes up by phrase length k:

1. Candidates are Apriori-safe: both (k-1)-word ends of a phrase must be
   frequent, or its count cannot be. The frequent ends go to the tasks as a bit
   map (by hash, so a few others slip in, none is lost). What
   passes is counted into hashed buckets, again as an upper bound: a phrase in
   a bucket that stays under the least count is no candidate either.
2. Candidates become double-array tries over words: from state s, word c leads
   to base[s] + c if check there is s. States are moved for many positions at
   once, level by level, and accepting states are added up. The most frequent
   candidates, a bounded number, make one trie that is broadcast; one pass
   over the corpus counts them. The same pass deals all other occurrences of
   candidates, packed, to blocks of candidates by the phrase's hash; each block
   has a trie of its own, which counts what is dealt to it. So a level takes
   the same few passes however many candidates there are.

Words are known by 64-bit hashes; all distinct words are checked for equal
hashes, and another seed is taken if there are any.
"""

from __future__ import annotations

import ctypes
import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskpanel.llm.common import give_back, parallelism, shipped, written
from riskpanel.llm.word_encoder import byte_sizes, groups

#: Bytes of text that share a dictionary.
BATCH_BYTES = 4_000_000
#: Bits of a bit map at least (8 MB) and at most (32 MB), and of one of the parts in which it is put together.
MAP_BITS, MOST_BITS, PART_BITS = 26, 28, 20
#: Bits of a bucket's number, and occurrences that a task holds before it sends them.
BUCKET_BITS, HELD = 40, 500_000
#: Positions of a batch that a task works on at a time.
POSITIONS = 250_000
#: Phrases of a trie: about 10 MB to broadcast (its states take 24 bytes each, its words 8).
TRIE_PHRASES = 300_000
#: Parts in which the tasks' counts of the broadcast trie's states are added up.
STATE_PARTS = 16
#: Batches' words, repeats included, of one slice of the words.
WORDS_SLICE = 1_000_000
#: Entries of one slice of buckets at most.
SLICE_ROWS = 4_000_000

_GOLD = np.uint64(0x9E3779B97F4A7C15)
#: Space and tab become a space, piece ends a full stop, A-Z small letters.
_TABLE = bytes(46 if chr(c) in ".,;:!?\n\x0b\x0c\r" else 32 if c in (9, 32) else c + 32 if 65 <= c <= 90 else c for c in range(256))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def phrase_hash(lang: str, words: list[np.ndarray]) -> np.ndarray:
    """Hash of phrases of one language, given as one array of word hashes for each position."""
    acc = np.full(len(words[0]), xxhash.xxh3_64_intdigest(lang), np.uint64)
    for w in words:
        acc = _mix((acc + w) * _GOLD)
    return acc


def cut_words(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """(words, codes): distinct words and, for every position of all texts in turn, 1 + the word's place or 0 at a piece's end."""
    joined = b".".join(texts).translate(_TABLE).replace(b".", b" . ")
    # the spaces left are the only ASCII white space that splits; bytes.split knows no other here but these
    flat = pa.array([joined], pa.large_binary()).view(pa.large_string())
    coded = pc.split_pattern(flat, " ").flatten().dictionary_encode()
    words = coded.dictionary.cast(pa.large_binary()).to_pylist()
    number, kept = np.empty(len(words), np.int32), []
    for i, w in enumerate(words):
        if w == b"":
            number[i] = -1
        elif w == b".":
            number[i] = 0
        else:
            kept.append(w)
            number[i] = len(kept)
    codes = number[coded.indices.to_numpy(zero_copy_only=False)]
    codes = codes[codes >= 0]
    stop = codes == 0  # one mark between pieces is enough
    return kept, np.append(codes[~(stop & np.roll(stop, 1))], 0).astype(np.int32)


def _code_type(words: int):
    """Type of the codes of a batch with so many distinct words."""
    return np.uint16 if words < 65_536 else np.int32


def encoded_corpus(docs: DataFrame, seed: int) -> DataFrame:
    """(lang, words, hashes, counts, n, codes): batches of texts of one language (null: und) as word numbers.

    words are joined by spaces, counts and codes are the bytes of 64-bit numbers and of numbers of ``_code_type``.
    """
    def run(batches):
        for b in batches:
            lang = pc.fill_null(b.column(0), "und").dictionary_encode()
            for k, name in enumerate(lang.dictionary.to_pylist()):
                text = b.column(1).filter(pc.equal(lang.indices, k))
                for first, n in groups(byte_sizes(text), BATCH_BYTES):
                    words, codes = cut_words([t or b"" for t in text.slice(first, n).to_pylist()])
                    times = np.bincount(codes, minlength=len(words) + 1)[1:]
                    codes = codes.astype(_code_type(len(words)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name]), pa.array([b" ".join(words)], pa.binary()),
                         pa.array([np.array([xxhash.xxh3_64_intdigest(w, seed) for w in words], np.uint64).view(np.int64)], pa.list_(pa.int64())),
                         pa.array([times.astype(np.int64).tobytes()], pa.binary()), pa.array([int(times.sum())], pa.int64()),
                         pa.array([codes.tobytes()], pa.binary())],
                        ["lang", "words", "hashes", "counts", "n", "codes"])

    return shipped(docs).select(F.col("lang"), F.col("text").cast("binary").alias("text")).mapInArrow(
        run, "lang string, words binary, hashes array<long>, counts binary, n long, codes binary")


def _words(corpus: DataFrame, slices: int) -> DataFrame:
    """(lang, h, word, f): the distinct words of the corpus with their counts.

    The words of a batch travel packed by slices of their hash; a slice adds up
    all batches' words that fall into it, a bounded number.
    """
    def run(batches):
        for b in batches:
            for lang, words, hashes, counts in zip(b.column("lang").to_pylist(), b.column("words"), b.column("hashes"), b.column("counts")):
                h = hashes.values.to_numpy(zero_copy_only=False).view(np.uint64)
                if not len(h):
                    continue
                of = _mix(h) % np.uint64(slices)
                order = np.argsort(of, kind="stable")
                h, times = h[order], np.frombuffer(counts.as_py(), np.int64)[order]
                spelt = words.as_py().split(b" ")
                cut = np.searchsorted(of[order], np.arange(slices + 1, dtype=np.uint64))
                rows = [(s, lang, b" ".join([spelt[i] for i in order[x:y]]), h[x:y].tobytes(), times[x:y].tobytes())
                        for s, (x, y) in enumerate(zip(cut[:-1], cut[1:])) if y > x]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(
                    (pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.binary()))], ["slice", "lang", "words", "hashes", "counts"])

    def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, more, pending = None, [], 0

        def merged():
            both = pa.concat_tables([*([] if total is None else [total]), *more])
            return both.group_by(["lang", "h", "word"], use_threads=False).aggregate([("f", "sum")]).rename_columns(
                ["lang", "h", "word", "f"])

        for b in parts:
            for lang, words, hashes, counts in zip(*[b.column(c).to_pylist() for c in ("lang", "words", "hashes", "counts")]):
                h = pa.array(np.frombuffer(hashes, np.int64))
                more.append(pa.table({"lang": pa.array([lang] * len(h), pa.string()), "h": h, "word": pa.array(words.split(b" "), pa.binary()),
                                      "f": pa.array(np.frombuffer(counts, np.int64))}))
                pending += len(h)
                if pending > max(0 if total is None else total.num_rows, 100_000):  # as many new as old: few passes over each
                    total, more, pending = merged(), [], 0
        if more:
            total = merged()
        if total is not None:
            yield from total.combine_chunks().to_batches(max_chunksize=100_000)

    packed = shipped(corpus).select("lang", "words", "hashes", "counts").mapInArrow(
        run, "slice int, lang string, words binary, hashes binary, counts binary")
    return packed.groupBy("slice").applyInArrow(add, "lang string, h long, word binary, f long")


def _corpus(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The written corpus and its (lang, h, word, f) of all distinct words, under a seed that gives each its own hash."""
    seed = 0
    while True:
        corpus = written(encoded_corpus(docs, seed), "phrase-corpus")
        size = corpus.agg(F.coalesce(F.sum(F.size("hashes")), F.lit(0))).first()[0]  # words of all batches, repeats included
        words = written(_words(corpus, max(64, -(-size // WORDS_SLICE))), "phrase-words")
        if words.groupBy("lang", "h").agg(F.count(F.lit(1)).alias("spellings")).filter("spellings > 1").isEmpty():
            return corpus, words
        seed += 1


def _hashes(b: pa.RecordBatch) -> np.ndarray:
    return b.column("h").to_numpy(zero_copy_only=False).view(np.uint64)


def _phrase_hashes(b: pa.RecordBatch) -> np.ndarray:
    """phrase_hash of every (lang, w)."""
    lang, out = b.column("lang").dictionary_encode(), np.zeros(b.num_rows, np.uint64)
    if b.num_rows:
        words = b.column("w").flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(b.num_rows, -1)
        index = lang.indices.to_numpy(zero_copy_only=False)
        for i, name in enumerate(lang.dictionary.to_pylist()):
            out[index == i] = phrase_hash(name, list(words[index == i].T))
    return out


def bit_map(rows: DataFrame, n: int, hashes=_hashes) -> list[bytes]:
    """A bit map of the top BUCKET_BITS of the hashes of n rows, as compressed parts: both bits of every hash are set.

    It grows with n between its least and its most size.
    """
    bits = min(MOST_BITS, max(MAP_BITS, (32 * n).bit_length()))

    def deal(batches):
        for b in batches:
            h = hashes(b)
            at = np.sort(np.concatenate([_first_bit(h, bits), _second_bit(h, bits)]))
            part = at >> np.uint64(PART_BITS)
            cut = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]])) if len(at) else []
            yield pa.RecordBatch.from_arrays([pa.array([int(part[x]) for x in cut[:-1]], pa.int32()), pa.array(
                [(at[x:y] % np.uint64(1 << PART_BITS)).astype(np.uint32).tobytes() for x, y in zip(cut[:-1], cut[1:])], pa.binary())], ["part", "at"])

    def run(key, table):
        out = np.zeros(1 << PART_BITS, bool)
        for at in table.column("at").to_pylist():
            out[np.frombuffer(at, np.uint32)] = True
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([zlib.compress(np.packbits(out).tobytes(), 1)], pa.binary())})

    parts = shipped(rows).mapInArrow(deal, "part int, at binary").groupBy("part").applyInArrow(run, "part int, bits binary")
    got = {r["part"]: bytes(r["bits"]) for r in parts.collect()}  # a part has 2^PART_BITS bits
    none = zlib.compress(bytes((1 << PART_BITS) // 8), 1)
    return [got.get(k, none) for k in range(1 << (bits - PART_BITS))]


def _unpacked(parts: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(map(zlib.decompress, parts)), np.uint8)


def _first_bit(h: np.ndarray, bits: int) -> np.ndarray:
    return h >> np.uint64(64 - bits)


def _second_bit(h: np.ndarray, bits: int) -> np.ndarray:
    return _mix(h >> np.uint64(64 - BUCKET_BITS)) >> np.uint64(64 - bits)


def _is_set(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> np.uint64(3)] >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8))) & np.uint8(1) != 0


def _has(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    size = (8 * len(bits)).bit_length() - 1
    out = _is_set(bits, _first_bit(h, size))
    left = np.flatnonzero(out)
    out[left] = _is_set(bits, _second_bit(h[left], size))
    return out


def _positions(lang: str, hashes: np.ndarray, codes: np.ndarray, k: int, ends: np.ndarray) -> np.ndarray:
    """Positions where a k-word phrase starts whose two (k-1)-word ends are in the bit map ``ends``."""
    n = len(codes) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    if k == 2:
        word = np.concatenate([[False], _has(ends, phrase_hash(lang, [hashes]))])
        return np.flatnonzero(word[codes[:-1]] & word[codes[1:]])
    inside = np.ones(n + 1, bool)  # starts of (k-1)-word phrases within a piece
    for i in range(k - 1):
        inside &= codes[i:i + n + 1] != 0
    at = np.flatnonzero(inside)
    ok = np.zeros(n + 1, bool)
    ok[at] = _has(ends, phrase_hash(lang, [hashes[codes[at + i] - 1] for i in range(k - 1)]))
    return np.flatnonzero(ok[:-1] & ok[1:])


def _batches(batches):
    libc = ctypes.CDLL(None)
    if hasattr(libc, "mallopt"):
        libc.mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD: freed arrays above 1 MB go back to the system
    for b in batches:
        give_back()  # what the batch before took
        for lang, hashes, codes in zip(b.column("lang").to_pylist(), b.column("hashes"), b.column("codes")):
            h = hashes.values.to_numpy(zero_copy_only=False).view(np.uint64)
            yield lang, h, np.frombuffer(codes.as_buffer(), _code_type(len(h)))


def _pieces(batches, k: int):
    """The batches in pieces of bounded length, in each of which every k-word phrase starts once."""
    for lang, hashes, codes in _batches(batches):
        for i in range(0, len(codes) - k + 1, POSITIONS):
            yield lang, hashes, codes[i:i + POSITIONS + k - 1]


def _planes(x: np.ndarray) -> bytes:
    """64-bit numbers, bytes of equal weight together: those of small numbers are zero and compress away."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T).tobytes()


def _from_planes(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()


def _steps(x: np.ndarray) -> bytes:
    """Sorted 64-bit numbers as the planes of their differences."""
    return _planes(np.diff(x, prepend=np.uint64(0)))


def _from_steps(b: bytes) -> np.ndarray:
    return np.cumsum(_from_planes(b), dtype=np.uint64)


def full_buckets(corpus: DataFrame, k: int, ends, least: int, slices: int) -> DataFrame:
    """(h): buckets, as the top bits of a hash, that at least ``least`` occurrences of possible phrases fall into.

    A task sends each bucket's count (at most ``least``, which is all that the
    sum needs) once for every HELD occurrences; buckets are spread over slices by hash.
    """
    shift, per = 64 - BUCKET_BITS, (1 << BUCKET_BITS) // slices

    def run(batches):
        held, size, known = [], 0, _unpacked(ends.value)

        def flush():
            bucket = np.concatenate(held)
            held.clear()
            bucket.sort()
            first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            times = np.minimum(np.diff(np.append(first, len(bucket))), least)
            bucket = bucket[first]
            cut = np.searchsorted(bucket, np.arange(1, slices, dtype=np.uint64) * np.uint64(per))
            rows = [(s, _steps(x), t.astype(np.uint32).tobytes()) for s, (x, t) in
                    enumerate(zip(np.split(bucket, cut), np.split(times, cut))) if len(x)]
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary()),
                                               pa.array([r[2] for r in rows], pa.binary())], ["slice", "buckets", "times"])

        for lang, hashes, codes in _pieces(batches, k):
            at = _positions(lang, hashes, codes, k, known)
            held.append(phrase_hash(lang, [hashes[codes[at + i] - 1] for i in range(k)]) >> np.uint64(shift))
            size += len(at)
            if size > HELD:
                yield flush()
                size = 0
        if size:
            yield flush()

    def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = times = np.zeros(0, np.uint64)
        more: list[tuple[np.ndarray, np.ndarray]] = []

        def merged():
            both = np.concatenate([bucket, *(x for x, _ in more)])
            count = np.concatenate([times, *(t for _, t in more)])
            order = np.argsort(both)
            both, count = both[order], count[order]
            first = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]]))
            return both[first], np.minimum(np.add.reduceat(count, first), np.uint64(least))

        pending = 0
        for b in parts:
            for x, t in zip(b.column("buckets"), b.column("times")):
                more.append((_from_steps(x.as_py()), np.frombuffer(t.as_py(), np.uint32).astype(np.uint64)))
                pending += len(more[-1][0])
                if pending > max(len(bucket), 100_000):  # as many new as old: each is sorted a few times only
                    bucket, times = merged()
                    more, pending = [], 0
        if more:
            bucket, times = merged()
        full = bucket[times >= least]
        yield pa.RecordBatch.from_arrays([pa.array((full << np.uint64(shift)).view(np.int64))], ["h"])

    parts = shipped(corpus).select("lang", "hashes", "codes").mapInArrow(run, "slice int, buckets binary, times binary")
    return parts.groupBy("slice").applyInArrow(add, "h long")


def _summed(lang: str, rows: np.ndarray, h: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct rows, each a phrase, their hashes and the sums of their times."""
    if not len(rows):
        return rows, h, times
    order = np.argsort(h)
    rows, h = rows[order], h[order]
    repeated = h[1:] == h[:-1]
    if (rows[1:][repeated] != rows[:-1][repeated]).any():  # two phrases with one hash: sorted by their words
        again = np.lexsort(rows.T)
        rows, h, order = rows[again], h[again], order[again]
        repeated = (rows[1:] == rows[:-1]).all(axis=1)
    first = np.flatnonzero(np.concatenate([[True], ~repeated]))
    return rows[first], h[first], np.add.reduceat(times[order], first)


def _once(n: int) -> np.ndarray:
    return np.ones(n, np.uint64)


def candidates(corpus: DataFrame, k: int, ends, buckets, slices: int) -> DataFrame:
    """(lang, w array<long>, h, sent): the distinct k-word phrases of the corpus that pass both bit maps.

    A task sends each of its phrases once, packed by slices of their hash; a slice has all copies of its phrases.
    h is the phrase's hash, sent how often it was sent: more for the more frequent ones.
    """
    def run(batches):
        held: dict[str, list] = {}
        size, known, full = 0, _unpacked(ends.value), _unpacked(buckets.value)

        def flush():
            out = []
            for lang, parts in held.items():
                rows, h = (np.concatenate(x) for x in zip(*parts))
                rows, h, _ = _summed(lang, rows, h, _once(len(rows)))
                of = h % np.uint64(slices)
                order = np.argsort(of, kind="stable")
                rows, of = rows[order], of[order]
                cut = np.searchsorted(of, np.arange(slices + 1, dtype=np.uint64))
                out += [(s, lang, rows[x:y].tobytes()) for s, (x, y) in enumerate(zip(cut[:-1], cut[1:])) if y > x]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(
                (pa.int32(), pa.string(), pa.binary()))], ["slice", "lang", "phrases"])

        for lang, hashes, codes in _pieces(batches, k):
            at = _positions(lang, hashes, codes, k, known)
            words = [hashes[codes[at + i] - 1] for i in range(k)]
            h = phrase_hash(lang, words)
            hit = np.flatnonzero(_has(full, h))
            rows, h, _ = _summed(lang, np.stack([w[hit] for w in words], axis=1), h[hit], _once(len(hit)))
            held.setdefault(lang, []).append((rows, h))
            size += len(rows)
            if size > HELD:
                yield flush()
                held, size = {}, 0
        if size:
            yield flush()

    def unite(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for b in parts:
            new: dict[str, list] = {}
            for lang, rows in zip(b.column("lang").to_pylist(), b.column("phrases")):
                new.setdefault(lang, []).append(np.frombuffer(rows.as_py(), np.uint64).reshape(-1, k))
            for lang, rows in new.items():
                rows = np.concatenate(rows)
                more = rows, phrase_hash(lang, list(rows.T)), _once(len(rows))
                seen[lang] = _summed(lang, *(more if lang not in seen else map(np.concatenate, zip(seen[lang], more))))
        for lang, (rows, h, sent) in seen.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(rows), pa.string()), _word_lists(rows), pa.array(h.view(np.int64)),
                                              pa.array(sent.view(np.int64))], ["lang", "w", "h", "sent"])

    found = shipped(corpus).select("lang", "hashes", "codes").mapInArrow(run, "slice int, lang string, phrases binary")
    return written(found.groupBy("slice").applyInArrow(unite, "lang string, w array<long>, h long, sent long"), "phrase-candidates")


def _word_lists(rows: np.ndarray) -> pa.Array:
    flat = pa.array(rows.view(np.int64).ravel())
    return pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, rows.shape[1], dtype=np.int32)), flat)


class Trie:
    """A double array over words: states of the phrases of a block, all of k words.

    ``alphabet`` are the sorted word hashes; word c (1 + its place) leads from
    state s to base[s] + c if check[base[s] + c] == s. Each language has a root.
    """

    def __init__(self, langs: list[str], phrases: np.ndarray, lang_of: np.ndarray):
        self.alphabet = np.unique(phrases)
        self.roots = {x: i + 1 for i, x in enumerate(langs)}
        words = np.searchsorted(self.alphabet, phrases).T + 1
        edges, prefix = [], lang_of.astype(np.int64)
        for word in words:  # distinct beginnings of every length: a third of the places will be taken
            distinct, prefix = np.unique(prefix << 32 | word, return_inverse=True)
            edges.append(len(distinct))
        room = 3 * (sum(edges) + len(langs)) + len(self.alphabet) + 64
        self.base, self.check = np.zeros(room, np.int32), np.zeros(room, np.int32)
        self.check[:len(langs) + 1] = -1  # the roots' own places
        self._rng = np.random.Generator(np.random.PCG64(11))
        state = lang_of + 1
        for word in words:
            state = self._level(state, word)
        self.state_of = state

    def _level(self, parent: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Give every distinct (parent, word) a place; returns the place of each pair."""
        edges, back = np.unique(parent.astype(np.int64) << 32 | word, return_inverse=True)
        p, c = (edges >> 32).astype(np.int32), (edges & 0xFFFFFFFF).astype(np.int32)
        first = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]]))
        times = np.diff(np.append(first, len(p)))
        todo = np.argsort(-times, kind="stable")
        wide = int((times >= 6).sum())
        for g in todo[:wide]:  # nodes with many words, widest first, one by one
            s = slice(first[g], first[g] + times[g])
            b = self._free_base(c[s])
            self.base[p[first[g]]] = b
            self.check[b + c[s]] = p[first[g]]
        rest = todo[wide:]
        while len(rest):  # the others all at once: those that hit no place taken and none of each other stay
            b = self._bases(len(rest))
            own = np.concatenate([np.arange(first[g], first[g] + times[g]) for g in rest])
            node = np.repeat(np.arange(len(rest)), times[rest])
            slot = b[node] + c[own]
            order = np.argsort(slot, kind="stable")
            twice = np.zeros(len(slot), bool)
            twice[order[1:]] = slot[order[1:]] == slot[order[:-1]]
            clash = np.zeros(len(rest), bool)
            clash[node[twice | (self.check[slot] != 0)]] = True
            good = ~clash[node]
            self.check[slot[good]] = p[own[good]]
            self.base[p[first[rest[~clash]]]] = b[~clash]
            rest = rest[clash]
        return (self.base[p] + c)[back]

    def _bases(self, n: int) -> np.ndarray:
        return self._rng.integers(0, len(self.check) - len(self.alphabet) - 1, n, dtype=np.int32)

    def _free_base(self, words: np.ndarray) -> int:
        for _ in range(20):
            tried = self._bases(max(1, 4096 // len(words)))
            fits = (self.check[tried[:, None] + words] == 0).all(axis=1)
            if fits.any():
                return int(tried[fits.argmax()])
        # no place among many tried: the array grows by one alphabet, so there is one
        old, more = len(self.check), np.zeros(len(self.alphabet) + 2, np.int32)
        self.base, self.check = np.concatenate([self.base, more]), np.concatenate([self.check, more])
        return old - 1

    def advance(self, lang: str, hashes: np.ndarray, codes: np.ndarray, k: int) -> np.ndarray:
        """The accepting states of all positions of a batch."""
        return self.accepted(lang, hashes, codes, k, np.arange(max(0, len(codes) - k + 1)))[1]

    def accepted(self, lang: str, hashes: np.ndarray, codes: np.ndarray, k: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those of the positions ``at`` of a batch where a phrase starts, and their accepting states."""
        root = self.roots.get(lang)
        if root is None:
            return np.zeros(0, np.int64), np.zeros(0, np.int32)
        word = np.concatenate([[0], self._places(hashes)]).astype(np.int32)[codes]
        state = np.full(len(at), root, np.int32)
        for i in range(k):
            c = word[at + i]
            to = self.base[state] + c
            ok = (c != 0) & (self.check[to] == state)
            at, state = at[ok], to[ok]
        return at, state

    def states(self, lang: str, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places of those rows of word hashes that are phrases, and their accepting states."""
        n, k = rows.shape
        return self.accepted(lang, rows.ravel(), np.arange(1, n * k + 1), k, np.arange(0, n * k, k))

    def _places(self, hashes: np.ndarray) -> np.ndarray:
        place = np.minimum(np.searchsorted(self.alphabet, hashes), len(self.alphabet) - 1)
        return np.where(self.alphabet[place] == hashes, place + 1, 0)


def _trie(lang: pa.Array, w: pa.Array) -> Trie:
    lang = lang.dictionary_encode()
    phrases = w.flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(len(w), -1)
    return Trie(lang.dictionary.to_pylist(), phrases, lang.indices.to_numpy(zero_copy_only=False))


def packed_trie(found: DataFrame) -> tuple[bytes, DataFrame]:
    """The trie of a bounded number of phrases (lang, w), compressed, and its (state, lang, w)."""
    def run(table):
        t, n = _trie(table.column("lang").combine_chunks(), table.column("w").combine_chunks()), table.num_rows
        packed = zlib.compress(pickle.dumps((t.alphabet, t.roots, t.base, t.check), protocol=5), 1)
        return pa.table({"state": pa.array(t.state_of, pa.int32()), "lang": table.column("lang"), "w": table.column("w"),
                         "trie": pa.array([packed] + [None] * (n - 1), pa.binary())})

    built = written(shipped(found).select("lang", "w", F.lit(0).alias("block")).groupBy("block").applyInArrow(
        run, "state int, lang string, w array<long>, trie binary"), "phrase-trie")
    return bytes(built.filter("trie is not null").select("trie").first()[0]), built.drop("trie")


def count_phrases(corpus: DataFrame, found: DataFrame, k: int, least: int, ends, buckets, slices: int) -> DataFrame:
    """(lang, w, f): the candidates that occur at least ``least`` times, with their exact counts.

    One pass over the corpus, whatever the number of candidates. Its rows go to
    blocks with the block's candidates sorted before them: blocks from 0 on have a
    hash's share of the candidates and what is dealt of their occurrences, those
    below 0 a range of the broadcast trie's states and the tasks' counts of them.
    """
    spark = corpus.sparkSession
    level = F.floor(F.log2("sent") * 8)  # at most some hundred
    sizes = sorted(((r["level"], r["count"]) for r in found.groupBy(level.alias("level")).count().collect()), reverse=True)
    total = sum(n for _, n in sizes)
    if not total:
        return spark.createDataFrame([], "lang string, w array<long>, f long")
    common, lowest = 0, None  # of the levels that fit into one trie
    for x, n in sizes:
        if common + n > TRIE_PHRASES:
            break
        common, lowest = common + n, x
    blocks = max(slices, -(-(total - common) // TRIE_PHRASES))
    rest = found if not common else found.filter(level < lowest)
    phrases = rest.select(F.pmod("h", F.lit(blocks)).cast("int").alias("block"), "lang", "w", F.lit(None).cast("int").alias("state"))
    shared, width = None, 1
    if common:
        trie, states = packed_trie(found.filter(level >= lowest))
        shared = spark.sparkContext.broadcast(trie)
        width = 1 + states.agg(F.max("state")).first()[0] // STATE_PARTS
        del trie
        phrases = phrases.unionByName(states.select((-1 - F.floor(F.col("state") / width)).cast("int").alias("block"), "lang", "w", "state"))

    def run(batches):
        held: dict[str, list] = {}
        size, known, full = 0, _unpacked(ends.value), _unpacked(buckets.value)
        t = Trie.__new__(Trie)
        if shared is not None:
            t.alphabet, t.roots, t.base, t.check = pickle.loads(zlib.decompress(shared.value))
        sums = np.zeros(0 if shared is None else len(t.check), np.uint64)

        def packed(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], x) for i, x in enumerate(
                (pa.int32(), pa.string(), pa.binary(), pa.binary()))], ["block", "lang", "items", "times"])

        def flush():
            out = []
            for lang, parts in held.items():
                rows, h = (np.concatenate(x) for x in zip(*parts))
                rows, h, times = _summed(lang, rows, h, _once(len(rows)))
                of = h.view(np.int64) % blocks
                order = np.argsort(of, kind="stable")
                rows, times, of = rows[order], times[order], of[order]
                cut = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1], [True]])) if len(of) else []
                out += [(int(of[x]), lang, rows[x:y].tobytes(), _planes(times[x:y])) for x, y in zip(cut[:-1], cut[1:])]
            return packed(out)

        for lang, hashes, codes in _pieces(batches, k):
            at = _positions(lang, hashes, codes, k, known)
            h = phrase_hash(lang, [hashes[codes[at + i] - 1] for i in range(k)])
            hit = _has(full, h)
            at, h = at[hit], h[hit]
            if shared is not None:
                there, state = t.accepted(lang, hashes, codes, k, at)
                np.add.at(sums, state.astype(np.intp), np.uint64(1))
                left = np.ones(len(codes), bool)
                left[there] = False
                left = left[at]
                at, h = at[left], h[left]
            held.setdefault(lang, []).append((np.stack([hashes[codes[at + i] - 1] for i in range(k)], axis=1), h))
            size += len(at)
            if size > HELD:
                yield flush()
                held, size = {}, 0
        if size:
            yield flush()
        hit = np.flatnonzero(sums).astype(np.uint64)
        cut = np.searchsorted(hit, np.arange(0, len(sums) + width, width, dtype=np.uint64))
        yield packed([(-1 - i, None, _steps(hit[x:y]), _planes(sums[hit[x:y]])) for i, (x, y) in enumerate(zip(cut[:-1], cut[1:])) if y > x])

    def count(batches):
        block, own, trie, sums = None, [], None, np.zeros(0, np.uint64)

        def ended():
            table = pa.Table.from_batches(own).combine_chunks()
            f = sums[trie.state_of if block >= 0 else table.column("state").to_numpy() - (-1 - block) * width]
            often = np.flatnonzero(f >= least)
            yield from pa.table({"lang": table.column("lang"), "w": table.column("w"), "f": pa.array(f.view(np.int64))}).take(
                often).combine_chunks().to_batches()

        for b in batches:
            blocks_, of_phrase = b.column("block").to_numpy(), b.column("items").is_null().to_numpy(zero_copy_only=False)
            cut = np.flatnonzero(np.concatenate([[True], (blocks_[1:] != blocks_[:-1]) | (of_phrase[1:] != of_phrase[:-1]), [True]]))
            for x, y in zip(cut[:-1].tolist(), cut[1:].tolist()):
                part = b.slice(x, y - x)
                if blocks_[x] != block:
                    if trie is not None or len(sums):
                        yield from ended()
                    block, own, trie, sums = int(blocks_[x]), [], None, np.zeros(0, np.uint64)
                if of_phrase[x]:
                    own.append(part.select(["lang", "w", "state"]))
                    continue
                if not own:
                    continue  # what slipped through the bit maps
                if not len(sums):
                    if block >= 0:
                        table = pa.Table.from_batches(own).combine_chunks()
                        trie = _trie(table.column("lang").chunk(0), table.column("w").chunk(0))
                    sums = np.zeros(len(trie.check) if block >= 0 else width, np.uint64)
                for lang, items, times in zip(part.column("lang").to_pylist(), part.column("items"), part.column("times")):
                    add = _from_planes(times.as_py())
                    if block >= 0:
                        place, state = trie.states(lang, np.frombuffer(items.as_py(), np.uint64).reshape(-1, k))
                        sums[state] += add[place // k]  # each phrase is in a row once
                    else:
                        sums[_from_steps(items.as_py()) - np.uint64((-1 - block) * width)] += add
        if trie is not None or len(sums):
            yield from ended()

    dealt = shipped(corpus).select("lang", "hashes", "codes").mapInArrow(run, "block int, lang string, items binary, times binary")
    both = phrases.unionByName(dealt, allowMissingColumns=True)
    got = written(both.repartition("block").sortWithinPartitions("block", F.col("items").isNotNull()).mapInArrow(
        count, "lang string, w array<long>, f long"), "phrase-frequent")
    if shared is not None:
        shared.destroy()
    return got


def mine_phrases(docs: DataFrame, least: int = 10, max_words: int = 3, top: int = 2000, drop_percent: int = 50) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases of 2 to ``max_words`` words.

    ``docs`` has lang and text; other columns are not used, repeated rows count
    each time. A-Z are lower-cased, texts split at . , ; : ! ? and line ends into
    pieces and those at spaces and tabs into words; a null text is empty, a null
    lang "und" (with any documents of that lang). a is the phrase's count (at
    least ``least``), l and r the counts of the two parts of its lowest-scoring
    cut (ties: the earliest), n all words of the language; score is
    floor(1000000 * a * a / (l * r)), exact. A phrase within a longer candidate
    that has at least ``drop_percent`` hundredths of its count is left out.
    Order: score and a descending, then the phrase by UTF-8 bytes. No documents,
    or none with a phrase often enough: no rows.
    """
    spark = docs.sparkSession
    sc = spark.sparkContext
    corpus, words = _corpus(docs)
    frequent = words.filter(F.col("f") >= least).select("lang", F.array("h").alias("w"), "f", "word")
    total = corpus.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    slices = 1 << max(6, int(np.ceil(np.log2(max(1, total / (SLICE_ROWS // 4))))))
    levels, last = [], frequent
    for k in range(2, max_words + 1):
        ends = sc.broadcast(bit_map(last.select("lang", "w"), last.count(), _phrase_hashes))
        full = written(full_buckets(corpus, k, ends, least, slices), "phrase-buckets")
        buckets = sc.broadcast(bit_map(full, full.count()))
        found = candidates(corpus, k, ends, buckets, slices)
        last = count_phrases(corpus, found, k, least, ends, buckets, slices)
        ends.destroy()
        buckets.destroy()
        levels.append(last)
        if last.isEmpty():
            break
    counts = frequent.select("lang", "w", "f")
    phrases = levels[0]
    for x in levels[1:]:
        phrases = phrases.unionByName(x)
    counts = counts.unionByName(phrases)

    # the longest count of a phrase that holds each shorter one
    parts = F.expr(f"""flatten(transform(sequence(2, {max_words}), k -> if(k >= size(w), array(),
        transform(sequence(1, size(w) - k + 1), i -> slice(w, i, k)))))""")
    inside = (phrases.filter("size(w) > 2").select("lang", F.explode(parts).alias("w"), "f")
              .groupBy("lang", "w").agg(F.max("f").alias("longer")))
    kept = written(phrases.join(inside, ["lang", "w"], "left").filter(
        F.col("longer").isNull() | (100 * F.col("longer").cast("decimal(20,0)") < drop_percent * F.col("f").cast("decimal(20,0)")))
        .select("lang", "w", F.col("f").alias("a")), "phrase-kept")

    # every cut with the counts of its two parts
    cuts = kept.select("lang", "w", "a", F.explode(F.expr("sequence(1, size(w) - 1)")).alias("k"))
    cuts = cuts.withColumn("first", F.expr("slice(w, 1, k)")).withColumn("rest", F.expr("slice(w, k + 1, size(w) - k)"))
    for side, name in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(counts.select("lang", F.col("w").alias(side), F.col("f").alias(name)), ["lang", side])
    exact = {c: F.col(c).cast("decimal(15,0)") for c in "alr"}
    cuts = cuts.withColumn("top", exact["a"] * exact["a"] * F.lit(1_000_000).cast("decimal(7,0)")) \
        .withColumn("under", exact["l"] * exact["r"]).withColumn("score", F.expr("top div under"))
    lowest = cuts.groupBy("lang", "w").agg(F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("s"))

    text = (kept.select("lang", "w", F.posexplode("w").alias("i", "one"))
            .join(frequent.select("lang", F.col("w")[0].alias("one"), F.col("word").cast("string").alias("word")), ["lang", "one"])
            .groupBy("lang", "w").agg(F.sort_array(F.collect_list(F.struct("i", "word"))).alias("x"))
            .select("lang", "w", F.concat_ws(" ", "x.word").alias("phrase")))
    # score classes, fine at every size; a language has about 1300 at most
    rows = written(lowest.join(text, ["lang", "w"]).select("lang", "phrase", "a", "s.l", "s.r", "s.score").withColumn(
        "class", F.floor(F.log2(F.col("score") + 1) * 64)), "phrase-scored")

    # a language may hold most phrases: whole classes that lie below the first ``top`` go, then, in parts of the
    # language, what ``top`` others of its part precede; only the rest is ranked in one place
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    above = Window.partitionBy("lang").orderBy(F.desc("class")).rowsBetween(Window.unboundedPreceding, -1)
    needed = (rows.groupBy("lang", "class").agg(F.count(F.lit(1)).alias("m"))
              .withColumn("above", F.coalesce(F.sum("m").over(above), F.lit(0))).filter(F.col("above") < top).select("lang", "class"))
    part = F.pmod(F.xxhash64("phrase"), F.lit(max(16, parallelism(docs))))
    rows = rows.join(needed, ["lang", "class"]).withColumn("part", part).withColumn(
        "r0", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("r0") <= top)
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")) \
        .filter(F.col("rank") <= top)
    n = corpus.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(n, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
