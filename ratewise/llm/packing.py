"""Packing documents into token windows by minimum bin slack.

A document's ids are cut at every full window; what remains is shorter than a window. The
remaining lengths of the whole corpus are a histogram of fewer than ``CAPACITY`` values, and the
plan is made on it: for the longest remaining length, a bitset subset-sum over the other lengths
finds the multiset that fills the window closest to capacity, the counts are read back from the
bitsets, and the pattern is used as often as its lengths last. The plan has at most one pattern
per length used up, so it stays small for any corpus; documents take their places in it by number.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import map_frames, ship, stored

CAPACITY = 2048
END_ID = 1
#: ASCII signs that the tokenizer's pre-tokenizer always parts from letters before
#: them (all but the apostrophe, which starts contractions).
SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"

#: Texts that are split and coded at once, and chunks whose ids are gathered at once: both bound memory.
PART_ROWS = 2048
PART_CHUNKS = 1 << 17


def _gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places of the runs (start, length), one after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


class Runs:
    """Id sequences in one array."""

    def __init__(self, sequences: list[bytes]):
        self.lengths = np.fromiter(map(len, sequences), np.int64, len(sequences)) // 4
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.ids = np.frombuffer(b"".join(sequences), "<u4")


class WordIds:
    """Token ids (little-endian unsigned 32-bit) of whole columns of texts.

    Blanks and line feeds always part the tokenizer's words, so a text's ids are its blank-free
    chunks' ids in a row. A column is split and dictionary-encoded by Arrow, and only its distinct
    chunks are looked at. Signs at a chunk's end are a word of their own if a letter stands before
    them, and stays a letter when the tokenizer composes and lower-cases it; so distinct chunks become
    fewer cores and tails. What is tokenised is gathered by array operations. The ids of cores are
    remembered over columns; the memory is forgotten when it has ``most`` entries.
    """

    def __init__(self, path: str, most: int = 250_000):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.letters: dict[str, bool] = {"": False}
        self.known, self.most = {"": b""}, most

    def _letter(self, c: str) -> bool:
        """Whether the character is only letters after composing and lower-casing."""
        if c not in self.letters:
            self.letters[c] = c.isalpha() and unicodedata.normalize("NFC", c).lower().isalpha()
        return self.letters[c]

    def _learn(self, cores: list[str]) -> None:
        """Cores of letters alone are one word each, so many are given to the tokenizer as one text
        and told apart by the tokens that end a word; if that count is off, and for all other
        cores, each is a text of its own."""
        letter, known = self._letter, self.known
        words = [c for c in cores if c.isalpha() and (c.isascii() or all(map(letter, c)))]
        groups = [words[lo:lo + 500] for lo in range(0, len(words), 500)]
        for g, e in zip(groups, self.tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(e.ids, "<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) == len(g):
                raw, lo = ids.tobytes(), 0
                for c, hi in zip(g, (4 * stops).tolist()):
                    known[c] = raw[lo:hi]
                    lo = hi
        rest = [c for c in cores if c not in known]
        for c, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
            known[c] = np.array(e.ids, "<u4").tobytes()

    def _encode(self, cores: list[str]) -> Runs:
        if len(self.known) > self.most:
            self.known = {"": b""}
        known = self.known
        self._learn([c for c in cores if c not in known])
        return Runs([known[c] for c in cores])

    def _chunks(self, distinct: pa.Array) -> Runs:
        """Ids of distinct chunks, by cores and tails."""
        core = pc.ascii_rtrim(distinct, SIGNS)
        last = pc.dictionary_encode(pc.utf8_slice_codeunits(core, -1))
        letter = np.array([self._letter(c) for c in last.dictionary.to_pylist()] or [False])
        # a special token is found before anything is cut, and as it is written
        special = pc.match_substring(distinct, "<|").to_numpy(zero_copy_only=False)
        cut = letter[last.indices.to_numpy()] & ~special if len(distinct) else np.empty(0, bool)
        core = pc.if_else(pa.array(cut), core, distinct)
        core = pc.if_else(pa.array(special), core, pc.ascii_lower(core))
        # what is left of a chunk behind its core; the core has as many bytes, lower-cased or not
        n = pc.binary_length(core).to_numpy().astype(np.int64)
        size = pc.binary_length(distinct).to_numpy().astype(np.int64)
        has = n < size
        left = (n - size)[has].tolist()
        tails = np.full(len(distinct), "", object)
        tails[has] = [c[k:] for c, k in zip(distinct.filter(pa.array(has)).to_pylist(), left)]
        both = []
        for column in (core, pa.array(tails, pa.string())):
            d = pc.dictionary_encode(column)
            both.append((self._encode(d.dictionary.to_pylist()), d.indices.to_numpy()))
        (heads, h), (ends, t) = both
        pool = np.concatenate([heads.ids, ends.ids])
        starts = np.stack([heads.starts[h], ends.starts[t] + len(heads.ids)], axis=1).ravel()
        lengths = np.stack([heads.lengths[h], ends.lengths[t]], axis=1).ravel()
        out = Runs([])
        out.ids = pool[_gather(starts, lengths)]
        out.lengths = lengths.reshape(-1, 2).sum(axis=1)
        out.starts = np.cumsum(out.lengths) - out.lengths
        return out

    def columns(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, offsets) of consecutive parts of a column; null is empty text. The parts bound the
        memory of the gathered ids, not the work."""
        texts = pc.replace_substring(pc.fill_null(texts, ""), "\n", " ")
        lists = pc.split_pattern(texts, " ")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        coded = pc.dictionary_encode(lists.flatten())
        runs, codes = self._chunks(coded.dictionary), coded.indices.to_numpy()
        offsets -= offsets[0] if len(offsets) else 0
        row = 0
        while row < len(texts):
            stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + PART_CHUNKS, side="right")) - 1)
            some = codes[offsets[row]:offsets[stop]]
            lengths = runs.lengths[some]
            ids = runs.ids[_gather(runs.starts[some], lengths)]
            ends = np.concatenate([[0], np.cumsum(lengths)])
            yield ids, ends[offsets[row:stop + 1] - offsets[row]]
            row = stop

    def ids(self, text: str) -> bytes:
        return b"".join(ids.tobytes() for ids, _ in self.columns(pa.array([text], pa.string())))


_TOKENIZERS: dict[str, WordIds] = {}
_PIECE = ["doc", "start", "length", "ids_crc32", "doc_tokens", "part", "number"]


def _cut(path: str, capacity: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _TOKENIZERS.get(path)
        if words is None:
            words = _TOKENIZERS[path] = WordIds(path)
        part, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        end = np.array([end_id], "<u4").tobytes()
        for b in batches:
            docs, at = b.column(0).to_pylist(), 0
            columns = (b.column(1).slice(lo, PART_ROWS) for lo in range(0, b.num_rows, PART_ROWS))
            for ids, offsets in (x for c in columns for x in words.columns(c)):
                rows = []
                for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                    raw = ids[lo:hi].tobytes() + end
                    n = len(raw) // 4
                    for start in range(0, n, capacity):
                        piece = raw[4 * start:4 * (start + capacity)]
                        length = len(piece) // 4
                        rows.append((docs[at], start, length, zlib.crc32(piece), n, part, seen[length]))
                        seen[length] += 1
                    at += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], _PIECE)
    return run


def fill(counts: dict[int, int], target: int) -> dict[int, int]:
    """The multiset of lengths (at most ``counts`` of each) whose sum is closest to ``target``
    from below, as {length: copies}; bit s of a bitset says that sum s can be reached."""
    mask = (1 << (target + 1)) - 1
    stages, reach = [], 1
    for length in sorted((x for x in counts if x <= target and counts[x] > 0), reverse=True):
        copies = min(counts[length], target // length)
        stages.append((length, copies, reach))
        step = 1
        while copies > 0:  # 1, 2, 4, ... copies at once reach every number of copies
            step = min(step, copies)
            reach |= (reach << (length * step)) & mask
            copies -= step
            step *= 2
        if reach >> target & 1:
            break
    total, used = reach.bit_length() - 1, {}
    for length, copies, before in reversed(stages):
        for k in range(copies + 1):
            rest = total - k * length
            if rest >= 0 and before >> rest & 1:
                if k:
                    used[length] = k
                total = rest
                break
    return used


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> pd.DataFrame:
    """Places for all pieces of the histogram {length: count}.

    Rows (length, first, span, copies, sequence, offset): the pieces of ``length`` numbered
    ``first`` to ``first + span - 1`` go ``copies`` to a sequence, from sequence ``sequence`` on,
    and lie there one after the other from ``offset`` on.
    """
    left = {x: n for x, n in histogram.items() if n > 0}
    taken = dict.fromkeys(left, 0)
    sequence, rows = 0, []
    while left:
        longest = max(left)
        rest = left | {longest: left[longest] - 1}
        used = fill(rest, capacity - longest)
        used[longest] = used.get(longest, 0) + 1
        times = min(left[x] // k for x, k in used.items())
        offset = 0
        for x, k in sorted(used.items(), reverse=True):
            rows.append((x, taken[x], k * times, k, sequence, offset))
            offset += x * k
            taken[x] += k * times
            left[x] -= k * times
            if not left[x]:
                del left[x]
        sequence += times
    return pd.DataFrame(rows, columns=["length", "first", "span", "copies", "sequence", "offset"], dtype="int64")


def _place(places):
    """Each piece's place: the last plan row of its length whose first number is not above its."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = places.value
        starts = (p["length"].to_numpy() << 44) | p["first"].to_numpy()
        for b in batches:
            k, length = b["number"].to_numpy(np.int64), b["length"].to_numpy(np.int64)
            i = np.searchsorted(starts, (length << 44) | k, side="right") - 1
            row = p.iloc[i]
            at = k - row["first"].to_numpy()
            copies = row["copies"].to_numpy()
            b["sequence_id"] = row["sequence"].to_numpy() + at // copies
            b["offset"] = row["offset"].to_numpy() + at % copies * length
            yield b[["doc", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]]
    return run


def pack(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text",
         capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: (key, start, length, ids_crc32, doc_tokens, sequence_id, offset).

    ``path`` is the tokenizer's file, readable on every executor. Null text is empty text: one
    piece, the end id alone. Repeated rows and null keys are packed like any other. An empty table
    gives no rows. Other columns are ignored.

    Texts are read once, in place: pieces are numbered per length and task while they are cut, and
    only these narrow rows are shuffled. The driver sees the histogram (at most ``capacity`` rows).
    """
    spark = docs.sparkSession
    ship(spark)
    named = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    pieces = stored(named.mapInArrow(_cut(path, capacity, end_id), ", ".join(f"{c} long" for c in _PIECE)), "pieces")
    dealt = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part")
                             .rowsBetween(Window.unboundedPreceding, -1))
    dealt = stored(dealt.withColumn("before", F.coalesce(before, F.lit(0))), "dealt")
    histogram = {r["length"]: r["n"] for r in dealt.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = plan(histogram, capacity).sort_values(["length", "first"], ignore_index=True)
    numbered = (pieces.join(dealt.select("length", "part", "before"), ["length", "part"])
                .withColumn("number", F.col("number") + F.col("before")))
    placed = map_frames(
        numbered.select("doc", "start", "length", "ids_crc32", "doc_tokens", "number"), _place(spark.sparkContext.broadcast(places)),
        "doc long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
    return placed.withColumnRenamed("doc", key)
