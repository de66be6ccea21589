"""Token arrays of neighbouring rows as codes of a chunk, so that a table of terms meets each distinct term
of a chunk once, not every token.

A chunk is what a task reads in one go, up to ``CHUNK_TOKENS`` tokens (or one row): its distinct terms are
stored as one row beside the rows that hold their codes. The terms are joined, in Spark, to whatever says
something about them, and the codes of a chunk become strings again in Arrow columns."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship, stored

CHUNK_TOKENS = 2 << 20


def flat(lists: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(all values of the lists, where each list begins and the last one ends); a null list is empty."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return lists.flatten(), np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])


def chunks(lists: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of up to ``CHUNK_TOKENS`` values, or of one row."""
    _, bounds = flat(lists)
    lo = 0
    while lo < len(lists):
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + CHUNK_TOKENS, side="right")) - 1)
        yield lo, min(hi, len(lists))
        lo = min(hi, len(lists))


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last column, the tokens, becomes codes; chunk and terms come behind it."""
    for b in batches:
        names = [*b.schema.names[:-1], "_codes", "_chunk", "_terms"]
        for lo, hi in chunks(b.column(b.num_columns - 1)):
            part = b.slice(lo, hi - lo)
            values, bounds = flat(part.column(part.num_columns - 1))
            coded, chunk = pc.dictionary_encode(values), uuid.uuid4().hex
            codes = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), coded.indices)
            rows, none = part.num_rows, [pa.nulls(1, f.type) for f in part.schema][:-1]
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], codes, pa.array([chunk] * rows), pa.nulls(rows, pa.list_(pa.string()))], names)
            terms = pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary)
            yield pa.RecordBatch.from_arrays([*none, pa.nulls(1, codes.type), pa.array([chunk]), terms], names)


def encode(df: DataFrame, tokens: str) -> tuple[DataFrame, DataFrame]:
    """(rows, terms): ``df`` with ``_chunk`` and ``_codes`` instead of ``tokens``, and (_chunk, _code, term).
    Chunks get their names as they are written: the two are one stored table."""
    ship(df.sparkSession)
    others = [f for f in df.schema.fields if f.name != tokens]
    fields = [*[T.StructField(f.name, f.dataType) for f in others], T.StructField("_codes", T.ArrayType(T.IntegerType())),
              T.StructField("_chunk", T.StringType()), T.StructField("_terms", T.ArrayType(T.StringType()))]
    kept = stored(df.select(*[f.name for f in others], tokens).mapInArrow(_encode, T.StructType(fields)), "coded")
    return (kept.where("_terms IS NULL").drop("_terms"),
            kept.where("_terms IS NOT NULL").select("_chunk", F.posexplode("_terms").alias("_code", "term")))


def _decode(names: list[str]):
    def run(rows: pa.Table, words: pa.Table) -> pa.Table:
        words = words.sort_by([("_code", "ascending"), ("_word", "ascending")])
        # one more code for null tokens, which stay null
        word = pa.concat_arrays([*words["_word"].chunks, pa.nulls(1, pa.string())])
        times = np.append(np.bincount(words["_code"].to_numpy()), 1) if words.num_rows else np.ones(1, np.int64)
        first = np.cumsum(times) - times
        codes, bounds = flat(rows["_codes"].combine_chunks())
        codes = pc.fill_null(codes, len(times) - 1).to_numpy()
        # a code stands for all of its words, in order
        ends = np.concatenate([[0], np.cumsum(times[codes])])
        at = np.repeat(first[codes] - ends[:-1], times[codes]) + np.arange(ends[-1])
        lists = pa.ListArray.from_arrays(pa.array(ends[bounds].astype(np.int32)), word.take(pa.array(at)))
        return pa.table([*[rows[c] for c in names[:-1]], lists], names)
    return run


def decode(rows: DataFrame, words: DataFrame, out: str) -> DataFrame:
    """``rows`` of :func:`encode` with the array ``out`` made of ``words`` (_chunk, _code, _word), which has at
    least one row for every code; all words of a code, ascending, take its place. A task holds one chunk."""
    names = [c for c in rows.columns if c not in ("_chunk", "_codes")]
    schema = T.StructType([*[rows.schema[c] for c in names], T.StructField(out, T.ArrayType(T.StringType()))])
    words = words.select(F.col("_chunk").alias("_of"), "_code", "_word")  # both sides may come from one table
    return rows.groupBy("_chunk").cogroup(words.groupBy("_of")).applyInArrow(_decode([*names, out]), schema)
