"""Cleaned texts and their lengths, made in Arrow columns by looking at bytes.

The rules are those of ``functions/text.py``; here they work on all bytes of a column of texts at once: one pass
puts ASCII letters in lower case and leaves digits and punctuation out, blanks cut the stream into pieces, stop
words are told by the first eight bytes of a piece, and the stemmer looks at its last ones. Nothing is
made a row or an object, and nothing depends on how often a word or a text comes again.

Only characters of which every engine thinks the same are seen to here: ASCII without control characters, Latin
letters with accents, and common signs beyond ASCII. Whatever else there is goes on to the column expressions:
the pieces that hold it where tokens are counted, the whole text where it is cleaned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import text as tx
from ..functions.stopwords import ENGLISH
from ..session import ship
from .pieces import parts

#: Ends a text in the stream; no byte of UTF-8.
END = 255
_DELETED = bytes(b for b in range(33, 127) if not chr(b).isalpha())  # ASCII digits and punctuation
_LOWER = bytes(b + 32 if 65 <= b <= 90 else 32 if b == 10 else b for b in range(256))
#: First bytes of characters that may be digits, white space or small ASCII letters to another engine (counting), or
#: that have a small form which is not made here (cleaning); and control characters, white space among them.
_CONTROL = [b for b in range(32) if b != 10] + [127]
_STRANGE = {"count": bytes([*_CONTROL, 0xC0, 0xC1, 0xC2, 0xD9, 0xDB, 0xDF, *range(0xE0, 0xE4), 0xEA, *range(0xEF, 0xFF)]),
            "clean": bytes([*_CONTROL, *range(0xC0, 0xC3), *range(0xC4, 0xFF)])}
_MARK = {kind: bytes(1 if b in strange else 0 for b in range(256)) for kind, strange in _STRANGE.items()}


class _Words:
    """The stop words that can be left after the deletions, by their first eight bytes."""

    SLOTS = 14

    def __init__(self, words: list[str]):
        short = sorted({w.encode() for w in words if w.isascii() and w.isalpha() and w.islower()})
        self.most = max(map(len, short), default=0)
        code = lambda b: int.from_bytes(b, "little")
        self.long = [(code(w[:8]), w) for w in short if len(w) > 8]
        codes = np.array([code(w) for w in short if len(w) <= 8], np.uint64)
        rnd = np.random.default_rng(1)
        while True:  # a factor that gives each word a slot of its own
            self.factor = np.uint64(int(rnd.integers(1 << 62)) * 2 + 1)
            slots = self._slot(codes)
            if len(np.unique(slots)) == len(codes):
                break
        self.table = np.zeros(1 << self.SLOTS, np.uint64)
        self.table[slots] = codes

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        return ((codes * self.factor) >> np.uint64(64 - self.SLOTS)).astype(np.int64)

    def among(self, stream: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Which pieces are stop words; ``stream`` goes on for eight bytes after the last piece."""
        found = np.zeros(len(starts), bool)
        at = np.flatnonzero((sizes > 0) & (sizes <= min(8, self.most)))
        if len(at):
            codes = self._codes(stream, starts[at]) & (np.uint64(0xFFFFFFFFFFFFFFFF) >> ((8 - sizes[at]) * 8).astype(np.uint64))
            found[at] = self.table[self._slot(codes)] == codes
        for head, word in self.long:
            at = np.flatnonzero(sizes == len(word))
            at = at[self._codes(stream, starts[at]) == np.uint64(head)]
            for i in range(8, len(word)):
                at = at[stream[starts[at] + i] == word[i]]
            found[at] = True
        return found

    @staticmethod
    def _codes(stream: np.ndarray, starts: np.ndarray) -> np.ndarray:
        code = np.zeros(len(starts), np.uint64)
        for i in range(8):
            code |= stream[starts + i].astype(np.uint64) << np.uint64(8 * i)
        return code


class _Stream:
    """The bytes of some texts in one stream, cut into pieces. A piece ends before a blank, or before the
    ``END`` of its text."""

    def __init__(self, texts: pa.Array, delete: bytes, kind: str):
        texts, valid = pc.fill_null(texts, ""), True
        try:
            texts.validate(full=True)
        except pa.ArrowInvalid:
            valid = False  # a text is no UTF-8: all of these go on to the column expressions
        texts = texts.cast(pa.binary())
        one = pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), texts)
        raw = pc.binary_join(one, bytes([END]))[0].as_buffer().to_pybytes() + bytes([END])
        self.bytes = raw.translate(_LOWER, delete)
        self.chars = np.frombuffer(self.bytes + bytes(8), np.uint8)
        real = self.chars[:-8]
        self.ends = np.flatnonzero((real == 32) | (real == END))
        self.starts = np.concatenate([[0], self.ends[:-1] + 1])
        self.sizes = self.ends - self.starts
        self.last = np.flatnonzero(real[self.ends] == END)  # the last piece of each text
        self.whole = valid and len(self.last) == len(texts)
        strange = np.flatnonzero(np.frombuffer(self.bytes.translate(_MARK[kind]), bool))
        if len(strange):  # signs: U+00A1 to U+00BF, dashes, quotes and dots from U+2010 to U+2027
            first, second, third = (self.chars[strange + i] for i in range(3))
            sign = ((first == 0xC2) & (second >= 0xA1)) | ((first == 0xE2) & (second == 0x80) & (third >= 0x90) & (third <= 0xA7))
            strange = strange[~sign]
        self.strange = np.unique(np.searchsorted(self.ends, strange))  # the pieces that hold such a character

    def strings(self, which: np.ndarray) -> pa.Array:
        """Pieces as strings, each with the byte behind it."""
        bounds = pa.array(np.concatenate([self.starts, [len(self.bytes)]]).astype(np.int32))
        return pa.BinaryArray.from_buffers(pa.binary(), len(self.starts), [None, bounds.buffers()[1], pa.py_buffer(self.bytes)]).take(pa.array(which))


def _lengths(words: _Words):
    """(number of tokens of the text without the pieces in ``rest``, those pieces)."""
    def some(texts: pa.Array) -> list[pa.Array]:
        null = texts.is_null().to_numpy(zero_copy_only=False)
        s = _Stream(texts, _DELETED, "count")
        if not s.whole:
            return [pa.array(np.zeros(len(texts), np.int32), mask=null), texts]
        token = (s.sizes > 0) & ~words.among(s.chars, s.starts, s.sizes)
        token[s.strange] = False
        upto = np.concatenate([[0], np.cumsum(token, dtype=np.int32)[s.last]])
        rest = pa.nulls(len(texts), pa.string())
        if len(s.strange):
            row = np.searchsorted(s.last, s.strange)
            offsets = np.searchsorted(row, np.arange(len(texts) + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pc.binary_replace_slice(s.strings(s.strange), -1, 1 << 30, b" "))
            rest = pc.binary_join(lists, b"").cast(pa.string())
            rest = pc.if_else(pa.array(np.diff(offsets) > 0), rest, None)
        return [pa.array(np.diff(upto).astype(np.int32), mask=null), rest]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in parts(b.column(0)):
                yield pa.RecordBatch.from_arrays(some(b.column(0).slice(lo, hi - lo)), ["known", "rest"])
    return run


def cleaned_lengths(df: DataFrame, text: str = "reviewText", out: str = "length") -> DataFrame:
    """(``out``): the number of tokens of the ``eda`` profile of each text, as a double; equal to
    :func:`text.cleaned_length`."""
    ship(df.sparkSession)
    counted = df.select(tx.untagged(text, "eda").alias("text")).mapInArrow(_lengths(_Words(ENGLISH)), "known int, rest string")
    more = F.when(F.col("rest").isNotNull(), F.size(tx.untagged_tokens("rest"))).otherwise(F.lit(0))
    none = F.size(F.lit(None).cast("array<string>"))  # what the session says of null
    return counted.select(F.when(F.col("known").isNull(), none).otherwise(F.col("known") + more).cast("double").alias(out))


def _stemmed(s: _Stream, chars: np.ndarray, stays: np.ndarray, keep: np.ndarray) -> None:
    """The S stemmer (:func:`text.s_stem`) on the pieces that stay: a y for ies, not after e or a, and no s at the end,
    not after u or s. ``keep`` tells which bytes are left."""
    at = np.flatnonzero(stays & (s.sizes > 3))
    at = at[chars[s.ends[at] - 1] == ord("s")]
    short = at[s.sizes[at] <= 12]  # up to three characters have at most twelve bytes
    inner = np.flatnonzero((chars & 0xC0) == 0x80)
    if len(inner) and len(short):
        n = s.sizes[short] - (np.searchsorted(inner, s.ends[short]) - np.searchsorted(inner, s.starts[short]))
        at = np.setdiff1d(at, short[n <= 3], assume_unique=True)
    ends = s.ends[at]
    two, three, four = (chars[ends - i] for i in (2, 3, 4))
    ies = (two == ord("e")) & (three == ord("i")) & (four != ord("e")) & (four != ord("a"))
    cut = ies | ((two != ord("u")) & (two != ord("s")))
    keep[ends[cut] - 1] = False
    keep[ends[ies] - 2] = False
    chars[ends[ies] - 3] = ord("y")


def _clean(delete: bytes, words: _Words, column: int, names: list[str]):
    """The rows with the cleaned text, and the text as it was where it is still to be cleaned."""
    def some(texts: pa.Array) -> tuple[pa.Array, pa.Array]:
        s = _Stream(texts, delete, "clean")
        if not s.whole:
            return pa.nulls(len(texts), pa.string()), texts
        chars = s.chars.copy()
        accent = np.flatnonzero(chars == 0xC3) + 1  # U+00C0 to U+00DE without the sign of multiplication
        accent = accent[(chars[accent] <= 0x9E) & (chars[accent] != 0x97) & (chars[accent] >= 0x80)]
        chars[accent] += 32
        stays = (s.sizes > 0) & ~words.among(chars, s.starts, s.sizes)
        keep = np.repeat(stays, s.sizes + 1)
        keep[s.ends[s.last]] = True
        _stemmed(s, chars, stays, keep)
        left = chars[:-8][keep]
        marks = np.flatnonzero(left == END)
        offsets = np.concatenate([[0], marks - np.arange(len(marks))]).astype(np.int32)
        made = pa.BinaryArray.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(offsets), pa.py_buffer(left[left != END].tobytes())])
        gone = texts.is_null().to_numpy(zero_copy_only=False)
        odd = np.zeros(len(texts), bool)
        odd[np.searchsorted(s.last, s.strange)] = True
        rest = pc.if_else(pa.array(odd), texts, None) if odd.any() else pa.nulls(len(texts), pa.string())
        made = pc.if_else(pa.array(odd | gone), None, made).cast(pa.string())
        return pc.ascii_rtrim(made, " "), rest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in parts(b.column(column)):
                part = b.slice(lo, hi - lo)
                made, rest = some(part.column(column))
                columns = [made if i == column else c for i, c in enumerate(part.columns)]
                yield pa.RecordBatch.from_arrays([*columns, rest], [*names, "_rest"])
    return run


def clean_texts(df: DataFrame, text: str = "reviewText", profile: str = "eda") -> DataFrame:
    """The rows with ``text`` cleaned, equal to :func:`text.clean_text` (profiles ``eda``, ``notebook`` and ``stem``)."""
    if profile not in ("eda", "notebook", "stem"):
        raise ValueError(f"no columnar form for profile {profile}")
    ship(df.sparkSession)
    whole = profile == "stem"
    bare = df if whole else df.withColumn(text, tx.untagged(text, "eda"))
    names = df.columns
    schema = T.StructType([*bare.schema.fields, T.StructField("_rest", T.StringType())])
    run = _clean(b"" if whole else _DELETED, _Words([] if whole else ENGLISH), names.index(text), names)
    rest = tx.tokenize(tx.lower("_rest")) if whole else tx.untagged_tokens("_rest")
    made = F.when(F.col("_rest").isNotNull(), tx.join_tokens(tx.lemmatize(rest))).otherwise(F.col(text))
    return bare.mapInArrow(run, schema).select(*[made.alias(c) if c == text else F.col(c) for c in names])
