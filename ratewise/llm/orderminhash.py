"""Document fingerprints by order min-hash.

A text is the list of its ``K``-letter windows, each numbered by how often it occurred before. For
each of ``M`` hash functions the two windows with the smallest hashes are kept in the order in
which they stand in the text, and the pair is hashed. Texts that share windows in the same order
share hashes, so the share of equal hashes follows the edit distance, not only the set of windows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import map_frames, ship, stored

K = 6
M = 32

_RNG = np.random.Generator(np.random.PCG64(77))
_XOR = _RNG.integers(0, 2**32, M, dtype=np.uint32)[:, None]
_MUL = (_RNG.integers(0, 2**32, M, dtype=np.uint32) | np.uint32(1))[:, None]
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_FEW = 4096


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _B
    return x ^ (x >> np.uint64(29))


def windows(text: str, k: int = K) -> np.ndarray:
    """64-bit hash of every window of ``k`` code points; of the whole text if it is shorter."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    k = min(k, len(c))
    if k == 0:
        return np.empty(0, np.uint64)
    h = np.full(len(c) - k + 1, k, np.uint64)
    for i in range(k):
        h = (h + c[i:len(c) - k + 1 + i]) * _A
        h ^= h >> np.uint64(32)
    return _mix(h)


def occurrences(h: np.ndarray) -> np.ndarray:
    """How often each value stands before its place: a sort of (value, place) in one number."""
    bits = np.uint64(max(1, int(len(h) - 1).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    order = np.sort((h & ~low) | np.arange(len(h), dtype=np.uint64))
    place = (order & low).astype(np.int64)
    index = np.arange(len(h))
    new = np.empty(len(h), bool)
    new[:1] = True
    np.not_equal(order[1:] >> bits, order[:-1] >> bits, out=new[1:])
    out = np.empty(len(h), np.uint64)
    out[place] = index - np.maximum.accumulate(np.where(new, index, 0))
    return out


def fingerprint(text: str) -> np.ndarray:
    """``M`` 32-bit hashes of ordered pairs of windows; without any window all are 0."""
    h = windows(text)
    if not len(h):
        return np.zeros(M, np.uint32)
    small = (_mix(h + occurrences(h) * _A) >> np.uint64(32)).astype(np.uint32)
    rows, most = np.arange(M), np.uint32(0xFFFFFFFF)
    values, places = [], []
    for lo in range(0, len(small), _FEW):
        v = (small[None, lo:lo + _FEW] ^ _XOR) * _MUL
        for _ in range(min(2, v.shape[1])):
            at = v.argmin(axis=1)
            values.append(v[rows, at])
            places.append(at + lo)
            v[rows, at] = most
    values, places = np.stack(values, axis=1), np.stack(places, axis=1)
    best = np.take_along_axis(places, np.argsort(values, axis=1, kind="stable")[:, :2], axis=1)
    best.sort(axis=1)
    out = h[best[:, 0]]
    if best.shape[1] > 1:
        out = _mix(out * _A + h[best[:, 1]])
    return (_mix(out + rows.astype(np.uint64)) >> np.uint64(32)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


def _hex(f: np.ndarray) -> str:
    return f.astype(">u4").tobytes().hex()


def compared(text: str, f: np.ndarray, after: str, after_f: np.ndarray) -> tuple:
    """(edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)."""
    half = len(text) // 2
    edited = text[:len(text) - half] + after[:half]
    e = f if edited == text else fingerprint(edited)
    sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
    return sha, _hex(f), _hex(e), likeness(f, e), likeness(f, after_f)


_COLUMNS = ["doc", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_RESULT = "doc long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _along(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come in order: each is compared with the one after it. The first and the last of the
    task's rows are passed on with their texts, as the last's next row is in another task."""
    part, before = TaskContext.get().partitionId(), None
    columns = [*_COLUMNS, "part", "end", "text"]
    for b in batches:
        out = []
        for doc, text in zip(b["doc"], b["text"]):
            text = text or ""
            f = fingerprint(text)
            if before is None:
                out.append((doc, *[None] * 6, part, "first", text))
            else:
                out.append((before[0], len(before[1]), *compared(before[1], before[2], text, f), part, None, None))
            before = doc, text, f
        yield pd.DataFrame(out, columns=columns).astype({"doc": "Int64", "n_chars": "Int64"})
    if before is not None:
        yield pd.DataFrame([(before[0], *[None] * 6, part, "last", before[1])], columns=columns).astype({"doc": "Int64", "n_chars": "Int64"})


def _across(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        out = [(doc, len(text), *compared(text, fingerprint(text), after, fingerprint(after)))
               for doc, text, after in zip(b["doc"], b["text"], b["after"])]
        yield pd.DataFrame(out, columns=_COLUMNS).astype({"doc": "Int64"})


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next), one
    row per row of ``docs``.

    The edited text has the last ``n_chars // 2`` code points replaced by the first as many of the
    next text in ascending key (all of it if it is shorter; the first row's after the last). Null
    text is empty text, whose fingerprint is all zeros. Null keys come first; rows with equal keys
    follow each other in the order in which they are stored. An empty table gives no rows. Other
    columns are ignored.

    One range shuffle brings the texts into order; a task reads its rows as a stream. Only the first
    and last text of each task are needed by another.
    """
    ship(docs.sparkSession)
    named = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text")).withColumn("tie", F.monotonically_increasing_id())
    ordered = named.repartitionByRange("doc", "tie").sortWithinPartitions("doc", "tie")
    along = stored(map_frames(ordered, _along, f"{_RESULT}, part int, end string, text string"), "along")
    first = along.where("end = 'first'").select("part", F.col("text").alias("after"))
    # one narrow row per task: the next task that has rows, or the first of all
    every = Window.orderBy("part")
    following = (first.select("part").withColumn("next", F.lead("part").over(every))
                 .withColumn("next", F.coalesce("next", F.min("part").over(Window.partitionBy()))))
    last = along.where("end = 'last'").select("doc", "text", "part").join(following, "part")
    ends = last.join(first.withColumnRenamed("part", "next"), "next").select("doc", "text", "after")
    out = along.where("end IS NULL").select(*_COLUMNS).union(map_frames(ends, _across, _RESULT))
    return out.withColumnRenamed("doc", key)
