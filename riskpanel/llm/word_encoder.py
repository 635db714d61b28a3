"""Token ids of many texts by way of their distinct words.

The tokenizer drops white space and never joins text across it, nor an ASCII
mark and an ASCII letter or digit beside it. So the bytes of a batch of texts
are cut at these places and the cuts numbered, all in numpy and Arrow; only
words that the worker has not met are tokenized, and the ids of all words are
gathered in one step.
"""

from __future__ import annotations

import json
import os
import re
import struct
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words whose ids a Python worker remembers, in two halves: when one is full, the one before it goes.
CACHED_WORDS = 500_000
#: Words of one call of the tokenizer.
_AT_ONCE = 200
#: Bytes of text encoded together.
GROUP_BYTES = 4_000_000
#: Runs of small letters that are not all ASCII.
_LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")
_SPACE, _MARK, _ALNUM, _OTHER = range(4)
#: Class of each byte: ASCII white space, marks but the apostrophe, letters and digits; all else.
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
_CLASS[[c for c in range(33, 127) if not chr(c).isalnum() and c != 39]] = _MARK
_CLASS[[c for c in range(128) if chr(c).isalnum()]] = _ALNUM
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Is there a cut between neighbours of these classes (4 x the first + the second)?
_AT_SPACE = np.array([(a == _SPACE) != (b == _SPACE) for a in range(4) for b in range(4)])
_CUT = _AT_SPACE | np.array([{a, b} == {_MARK, _ALNUM} for a in range(4) for b in range(4)])
#: The same as tables for bytes.translate.
_KINDS, _SPACE_CUTS, _CUTS = (np.resize(x, 256).tobytes() for x in (_CLASS, _AT_SPACE, _CUT))
_NONE = pa.array([], pa.large_binary())


def _cuts(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(words, firsts): the cuts of all texts in turn (white space included), those of text i from firsts[i] on.

    A-Z are lower-cased, except where a special token may stand in the texts:
    those are found before lower-casing, and words are then cut at white space only.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0]:bounds[-1]].tobytes()
    bounds = bounds - bounds[0]
    special = b"<|" in data
    if not special:
        data = data.translate(_LOWER)
    kind = np.frombuffer(data.translate(_KINDS), np.uint8)
    cut = np.ones(len(data) + 1, bool)
    cut[1:-1] = np.frombuffer((4 * kind[:-1] + kind[1:]).tobytes().translate(_SPACE_CUTS if special else _CUTS), bool)
    cut[bounds] = True
    offsets = np.flatnonzero(cut)
    words = pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return words, np.searchsorted(offsets, bounds)


class WordEncoder:
    """Ids of texts, each distinct word encoded once.

    Runs of small letters are encoded many in one call (with the file's own
    model and byte mapping) and told apart by the tokens that end a word. All
    other words go through the whole tokenizer one by one. Words met before and
    their ids are kept in Arrow arrays, ``words`` and ``ids`` (``older`` and
    ``older_ids``: the half before), and whole batches are looked up in them.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, models, pre_tokenizers
        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["merges"]]
        options = {k: v for k, v in spec.items() if k not in ("type", "vocab", "merges") and v is not None}
        # no cache of the model's own: it gets each word once
        model = models.BPE(vocab=spec["vocab"], merges=merges, cache_capacity=0, **options)
        self.ascii, self.letters = Tokenizer(model), Tokenizer(model)
        spaces, as_bytes = pre_tokenizers.CharDelimiterSplit(" "), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.ascii.pre_tokenizer = spaces  # ASCII letters stand for their own bytes
        self.letters.pre_tokenizer = pre_tokenizers.Sequence([spaces, as_bytes])
        vocabulary = self.whole.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.words = self.ids = self.older = self.older_ids = _NONE
        self.learned: dict[bytes, bytes] = {}

    def encode_column(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): the ids of all texts (a string column; null: empty) in turn, as little-endian unsigned
        32-bit numbers, those of text i at offsets[i] up to offsets[i + 1]; each text ends with ``end_id`` if given."""
        words, firsts = _cuts(texts)
        coded = words.dictionary_encode()
        gathered = self._ids_of(coded.dictionary).take(coded.indices)
        ends = np.frombuffer(gathered.buffers()[1], np.int64, len(gathered) + 1) if len(gathered) else np.zeros(1, np.int64)
        ids = np.frombuffer(gathered.buffers()[2], "<u4") if ends[-1] else np.zeros(0, "<u4")
        offsets = ends[firsts] // 4
        if end_id is not None:
            ids = np.insert(ids[:offsets[-1]], offsets[1:], np.uint32(end_id))
            offsets = offsets + np.arange(len(offsets))
        return ids, offsets

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit numbers, without special tokens added."""
        ids, at = self.encode_column(pa.array([t.decode() for t in texts], pa.string()))
        return [ids[a:b].tobytes() for a, b in zip(at[:-1], at[1:])]

    def _ids_of(self, distinct: pa.Array) -> pa.Array:
        """Ids of each of these different words, which are remembered; words that keep coming are tokenized once only."""
        at = pc.index_in(distinct, value_set=self.words)
        if len(self.words) + at.null_count > CACHED_WORDS // 2:
            self.older, self.older_ids, self.words, self.ids = self.words, self.ids, _NONE, _NONE
            at = pa.nulls(len(distinct), pa.int32())
        missing = distinct.filter(at.is_null())
        before = pc.index_in(missing, value_set=self.older)
        new = missing.filter(before.is_null()).to_pylist()
        self._learn(new)
        ids = pc.replace_with_mask(self.older_ids.take(before), before.is_null(),
                                   pa.array([self.learned[w] for w in new], pa.large_binary()))
        self.learned = {}
        added = pa.array(np.arange(len(self.words), len(self.words) + len(missing)), pa.int32())
        self.words, self.ids = pa.concat_arrays([self.words, missing]), pa.concat_arrays([self.ids, ids])
        return self.ids.take(pc.replace_with_mask(at, at.is_null(), added))

    def _learn(self, new: list[bytes]) -> None:
        ascii, letters, other = [], [], []
        for w in new:
            if w.isspace():
                self.learned[w] = b""
            elif w.isalpha() and w.islower():
                ascii.append(w)
            elif w.islower() and _LETTERS.fullmatch(w):
                letters.append(w)
            else:
                other.append(w)
        self._letter_runs(ascii, self.ascii)
        self._letter_runs(letters, self.letters)
        self._one_by_one(other)

    def _letter_runs(self, runs: list[bytes], tokenizer) -> None:
        for i in range(0, len(runs), _AT_ONCE):
            part = runs[i:i + _AT_ONCE]
            got = tokenizer.encode_batch_fast([b" ".join(part).decode()], add_special_tokens=False)[0].ids
            ids = np.array(got, "<u4")
            last = np.flatnonzero(self.ends[ids]) + 1
            if len(last) != len(part):
                self._one_by_one(part)
                continue
            whole, start = ids.tobytes(), 0
            for w, end in zip(part, (4 * last).tolist()):
                self.learned[w] = whole[start:end]
                start = end

    def _one_by_one(self, words: list[bytes]) -> None:
        for i in range(0, len(words), 4000):
            part = words[i:i + 4000]
            got = self.whole.encode_batch_fast([w.decode() for w in part], add_special_tokens=False)
            for w, e in zip(part, got):
                self.learned[w] = struct.pack(f"<{len(e.ids)}I", *e.ids)


@lru_cache(maxsize=1)
def word_encoder(path: str) -> WordEncoder:
    """One for each Python worker."""
    return WordEncoder(path)


def groups(sizes: np.ndarray, most: int = GROUP_BYTES):
    """(first row, rows) of runs of consecutive rows with about ``most`` bytes; a larger row is a run of its own."""
    start, held = 0, 0
    for r, n in enumerate(sizes.tolist()):
        if held and held + n > most:
            yield start, r - start
            start, held = r, 0
        held += n
    if start < len(sizes):
        yield start, len(sizes) - start


def byte_sizes(texts: pa.Array) -> np.ndarray:
    """UTF-8 bytes of each text (null: none)."""
    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
