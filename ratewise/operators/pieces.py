"""Blank-cut pieces of texts, counted in Arrow columns inside the tasks.

A task cuts a column of texts at blanks and line feeds by looking at its bytes, gives each piece a code
and counts codes (or pairs of codes); no piece becomes an object or a row before it is counted. What a
task holds is bounded by ``MOST`` and ``MOST_BYTES``: counts are given out when there is more, and Spark adds them up
over the tasks. What the pieces mean (lower case, deletions, words, stop words, stems) is left to the
column expressions of ``functions/text.py``, once per piece or pair that is given out. Only ASCII
pieces, where all engines agree, are brought to their clean form here, so that fewer pairs differ.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship

#: Bytes of text that are cut at once; counts (twice what stays after adding up), pieces or groups, and
#: bytes of pieces that a task holds; rows that it gives out at once.
PART_BYTES = 16 << 20
MOST = 1 << 22
MOST_NAMES = 1 << 20
MOST_BYTES = 96 << 20
OUT_ROWS = 1 << 16

#: Letters that no Unicode version, lower-casing or cleaning step takes for anything else
#: (without the dotted capital I, whose small form is two characters, and the long s).
LETTERS = ("À-ÖØ-öø-įı-žΑ-ΡΣ-ώЀ-ҁҊ-ԯא-ת"
           "ؠ-يअ-हぁ-ゖァ-ヺ一-龥가-힣")
#: What a piece certainly is: without a word, perhaps with words, with a word, or itself one clean word.
GONE, UNSURE, SURE, PLAIN = range(4)


def parts(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``PART_BYTES`` each."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offsets, int(offsets[lo]) + PART_BYTES, side="right")) - 1)
        yield lo, min(hi, len(texts))
        lo = min(hi, len(texts))


def cut(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(pieces, number of pieces of each text); a piece still has the blank or line feed behind it, and
    may be nothing else. Null is empty text."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data and offsets[-1] > offsets[0] else np.empty(0, np.uint8)
    offsets = offsets - offsets[0]
    begins = np.zeros(len(data) + 1, bool)
    np.logical_or(data == 32, data == 10, out=begins[1:])
    begins[offsets] = True
    bounds = np.flatnonzero(begins).astype(np.int32)
    pieces = pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data)))
    return pieces, np.diff(np.searchsorted(bounds, offsets))


class _Counts:
    """Counts of one task: of a string's code and a second number (0 or more), both in one key."""

    def __init__(self):
        self.names, self.plain = pa.array([], pa.string()), np.empty(0, bool)
        self.groups: dict[tuple, int] = {}
        self.keys, self.counts, self.rows = [], [], 0

    def codes(self, strings: pa.Array, plain: np.ndarray | None = None) -> np.ndarray:
        """Codes of distinct strings."""
        at = pc.index_in(strings, value_set=self.names)
        new = at.is_null().to_numpy(zero_copy_only=False)
        at = pc.fill_null(at, 0).to_numpy().astype(np.int64)
        at[new] = len(self.names) + np.arange(int(new.sum()))
        self.names = pa.concat_arrays([self.names, strings.filter(pa.array(new))])
        if plain is not None:
            self.plain = np.concatenate([self.plain, plain[new]])
        return at

    def add(self, code: np.ndarray, other: np.ndarray, counts: np.ndarray | None = None) -> None:
        keys = (code << 32) | other
        if counts is None:
            counted = pc.value_counts(pa.array(keys))
            keys, counts = counted.field(0).to_numpy(), counted.field(1).to_numpy()
        self.keys.append(keys)
        self.counts.append(counts)
        self.rows += len(keys)
        if self.rows > MOST:
            self.merge()

    def merge(self) -> None:
        keys, counts = np.concatenate(self.keys), np.concatenate(self.counts)
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        self.keys, self.counts, self.rows = [keys[first]], [np.add.reduceat(counts, first)], len(first)

    def full(self) -> bool:
        return self.rows > MOST // 2 or max(len(self.names), len(self.groups)) > MOST_NAMES or self.names.nbytes > MOST_BYTES

    def out(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(codes, second numbers, counts) of all that is held, in parts."""
        if self.rows:
            self.merge()
            (keys,), (counts,) = self.keys, self.counts
            for lo in range(0, len(keys), OUT_ROWS):
                some = keys[lo:lo + OUT_ROWS]
                yield some >> 32, some & 0xFFFFFFFF, counts[lo:lo + OUT_ROWS]


def _add_pieces(held: _Counts, by: list[pa.Array], coded: pa.DictionaryArray, bare: pa.Array, per_row: np.ndarray) -> None:
    """Count the pieces of some texts, per row of ``by``; ``bare`` has the distinct ones without what ends them."""
    key, size = coded.indices.to_numpy(), len(coded.dictionary)
    # the groups of the rows, numbered within the part and for the task
    group, total = np.zeros(len(per_row), np.int64), 1
    values = [pc.dictionary_encode(c, null_encoding="encode") for c in by]
    for d in values:
        _, group = np.unique(group * len(d.dictionary) + d.indices.to_numpy(), return_inverse=True)
        total = int(group.max()) + 1
    _, row = np.unique(group, return_index=True)
    tuples = zip(*[c.take(pa.array(row)).to_pylist() for c in by]) if by else [()]
    number = np.array([held.groups.setdefault(t, len(held.groups)) for t in tuples], np.int64)
    if total > 1:
        key = np.repeat(group * size, per_row) + key
    if total * size <= 4 * len(key) + 1024:
        n = np.bincount(key)
        keys = np.flatnonzero(n)
        n = n[keys]
    else:
        keys, n = np.unique(key, return_counts=True)
    bare = pc.dictionary_encode(bare)
    code = held.codes(bare.dictionary)[bare.indices.to_numpy()]
    some = pc.not_equal(bare.dictionary, "").to_numpy(zero_copy_only=False)[bare.indices.to_numpy()][keys % size]
    keys, n = keys[some], n[some]
    held.add(code[keys % size], number[keys // size], n)


def _count(names: list[str]):
    """Counts per group (all columns but the last) and piece of the last column."""
    def given(held: _Counts, types: list[pa.DataType]) -> Iterator[pa.RecordBatch]:
        groups = [pa.array(values, kind) for values, kind in zip(zip(*held.groups), types)]
        for code, group, n in held.out():
            at = pa.array(group)
            yield pa.RecordBatch.from_arrays([*[g.take(at) for g in groups], held.names.take(pa.array(code)), pa.array(n, pa.int64())], [*names, "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, types, last = _Counts(), [], len(names) - 1
        for b in batches:
            types = b.schema.types[:last]
            for lo, hi in parts(b.column(last)):
                part = b.slice(lo, hi - lo)
                pieces, per_row = cut(part.column(last))
                if not len(pieces):
                    continue
                coded = pc.dictionary_encode(pieces)
                _add_pieces(held, [part.column(i) for i in range(last)], coded, pc.ascii_rtrim(coded.dictionary, " \n"), per_row)
                if held.full():
                    yield from given(held, types)
                    held = _Counts()
        yield from given(held, types)
    return run


def piece_counts(df: DataFrame, text: Column, by: list[str] | None = None, term: str = "term") -> DataFrame:
    """(by..., term, n): how often each piece stands in the texts of each group."""
    by = by or []
    ship(df.sparkSession)
    rows = df.select(*by, text.alias(term))
    schema = T.StructType([*rows.schema.fields[:-1], T.StructField(term, T.StringType()), T.StructField("n", T.LongType())])
    return rows.mapInArrow(_count([*by, term]), schema).groupBy(*by, term).agg(F.sum("n").alias("n"))


def settle_eda(pieces: pa.Array, words: list[str]) -> tuple[pa.Array, np.ndarray]:
    """(pieces, what each is) for the ``eda`` profile, ASCII pieces in clean form."""
    plain = pc.and_(pc.string_is_ascii(pieces), pc.invert(pc.match_substring_regex(pieces, r"[\t\x0b\f\r\x1c-\x1f]")))
    clean = pc.replace_substring_regex(pc.if_else(plain, pc.ascii_lower(pieces), ""), r"[0-9!-/:-@\[-`{-~]", "")
    gone = pc.is_in(clean, value_set=pa.array(["", *words]))
    other = np.where(pc.match_substring_regex(pieces, f"[{LETTERS}]").to_numpy(zero_copy_only=False), SURE, UNSURE)
    known = np.where(gone.to_numpy(zero_copy_only=False), GONE, PLAIN)
    return pc.if_else(plain, clean, pieces), np.where(plain.to_numpy(zero_copy_only=False), known, other)


def settle_cloud(pieces: pa.Array, words: list[str]) -> tuple[pa.Array, np.ndarray]:
    """(pieces, what each is) for the words of the term cloud, ASCII pieces in small letters and without
    the signs around them. Stop words are words here."""
    ascii_ = pc.string_is_ascii(pieces)
    clean = pc.ascii_trim(pc.if_else(ascii_, pc.ascii_lower(pieces), ""), "!\"#$%&()*+,-./:;<=>?@[\\]^`{|}~")
    has = pc.match_substring_regex(clean, "[a-z0-9_][a-z0-9_']").to_numpy(zero_copy_only=False)
    whole = pc.match_substring_regex(clean, "^[a-z0-9_][a-z0-9_']+$").to_numpy(zero_copy_only=False)
    other = np.where(pc.match_substring_regex(pieces, f"[A-Za-z0-9_{LETTERS}][A-Za-z0-9_{LETTERS}]").to_numpy(zero_copy_only=False), SURE, UNSURE)
    known = np.where(whole, PLAIN, np.where(has, SURE, GONE))
    return pc.if_else(ascii_, clean, pieces), np.where(ascii_.to_numpy(zero_copy_only=False), known, other)


def _add_spans(held: _Counts, clean: pa.Array, state: np.ndarray, at: np.ndarray, per_row: np.ndarray) -> None:
    """Count the spans of some texts: the piece at each place is ``clean[at]``, ``state`` tells what it is."""
    distinct = pc.dictionary_encode(clean)
    code, row = distinct.indices.to_numpy()[at], np.repeat(np.arange(len(per_row)), per_row)
    stays = np.flatnonzero(state != GONE)
    if not len(stays):
        return
    code, state, row = code[stays], state[stays], row[stays]
    first = np.concatenate([[True], row[1:] != row[:-1]])
    starts = np.flatnonzero(first | (state >= SURE))
    sizes = np.diff(np.append(starts, len(code)))
    plain = np.zeros(len(distinct.dictionary), bool)
    plain[code[state == PLAIN]] = True
    known = held.codes(distinct.dictionary, plain)
    head, tail = known[code[starts]], np.full(len(starts), -1, np.int64)
    same = np.flatnonzero(~first[starts[1:]])
    tail[same] = head[same + 1]
    long = np.flatnonzero(sizes > 1)
    if len(long):
        ends = np.cumsum(sizes[long])
        where = np.repeat(starts[long] - (ends - sizes[long]), sizes[long]) + np.arange(int(ends[-1]))
        lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), distinct.dictionary.take(pa.array(code[where])))
        joined = pc.dictionary_encode(pc.binary_join(lists, " "))
        head[long] = held.codes(joined.dictionary, np.zeros(len(joined.dictionary), bool))[joined.indices.to_numpy()]
    held.add(head, tail + 1)


def _spans(settle, words: list[str]):
    def given(held: _Counts) -> Iterator[pa.RecordBatch]:
        for head, tail, n in held.out():
            none, tail = tail == 0, np.maximum(tail, 1) - 1
            plain = held.plain[head] & (none | held.plain[tail])
            yield pa.RecordBatch.from_arrays([held.names.take(pa.array(head)), held.names.take(pa.array(tail, mask=none)), pa.array(plain),
                                              pa.array(n, pa.int64())], ["head", "tail", "plain", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _Counts()
        for b in batches:
            for lo, hi in parts(b.column(0)):
                pieces, per_row = cut(b.column(0).slice(lo, hi - lo))
                coded = pc.dictionary_encode(pieces)
                clean, state = settle(pc.ascii_rtrim(coded.dictionary, " \n"), words)
                at = coded.indices.to_numpy()
                _add_spans(held, clean, state[at], at, per_row)
                if held.full():
                    yield from given(held)
                    held = _Counts()
        yield from given(held)
    return run


def neighbour_counts(df: DataFrame, text: Column, settle, words_of, words: list[str]) -> DataFrame:
    """(a, b, n): how often the word ``b`` follows the word ``a`` in the texts; ``b`` is null after the last
    word of a text, so that ``a`` adds up to the counts of the words.

    ``words_of`` makes the words of a text (an array) and must work piece by piece: the words of a text are
    those of its blank-cut pieces. ``settle`` (one of this module) tells pieces that certainly hold a word
    or none; ``words`` are left out by it. A span runs from a piece that certainly holds a word to the next
    one; whatever stands between the two and may hold words is handed over as it is. Spans are counted in
    the tasks; their words are made once per span that is given out: all of the head and the first of the tail."""
    ship(df.sparkSession)
    return pairs_of(df.select(text.alias("text")).mapInArrow(_spans(settle, list(words)), "head string, tail string, plain boolean, n long"), words_of)


def pairs_of(spans: DataFrame, words_of) -> DataFrame:
    """The second half of :func:`neighbour_counts`: the words of spans (head, tail, plain, n)."""
    plain, tail = F.col("plain"), F.col("tail")
    none = F.array().cast("array<string>")
    spans = spans.select("head", "tail", "plain", "n", F.when(~plain, words_of(F.col("head"))).alias("w"),
                         F.when(~plain & tail.isNotNull(), F.slice(words_of(tail), 1, 1)).otherwise(none).alias("t"))
    made = F.transform("w", lambda a, i: F.struct(a.alias("a"), F.coalesce(F.get(F.col("w"), i + 1), F.when(i + 1 == F.size("w"), F.get(F.col("t"), F.lit(0)))).alias("b")))
    pairs = F.when(plain, F.array(F.struct(F.col("head").alias("a"), tail.alias("b")))).otherwise(made)
    return spans.select(F.explode_outer(pairs).alias("p"), "n").where("p IS NOT NULL").select("p.a", "p.b", "n")


#: What a row of :func:`profile` is.
LENGTH, PIECE, SPAN = range(3)
_SPACES = "[\t\x0b\f\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
_PROFILE = "kind int, head string, tail string, plain boolean, rating double, use int, n long"
_PROFILE_TYPES = [pa.int32(), pa.string(), pa.string(), pa.bool_(), pa.float64(), pa.int32(), pa.int64()]


def _profile(words: list[str]):
    def rows(kind: int, n: np.ndarray | pa.Array, **columns: pa.Array) -> pa.RecordBatch:
        names = [c.split()[0] for c in _PROFILE.split(", ")]
        columns |= {"kind": pa.array(np.full(len(n), kind, np.int32)), "n": pa.array(n, pa.int64())}
        return pa.RecordBatch.from_arrays([columns[c] if c in columns else pa.nulls(len(n), t) for c, t in zip(names, _PROFILE_TYPES)], names)

    def given(pieces_: _Counts, spans: _Counts) -> Iterator[pa.RecordBatch]:
        rating, use = (pa.array(values, kind) for values, kind in zip(zip(*pieces_.groups), (pa.float64(), pa.int32()))) if pieces_.groups else (None, None)
        for code, group, n in pieces_.out():
            yield rows(PIECE, n, head=pieces_.names.take(pa.array(code)), rating=rating.take(pa.array(group)), use=use.take(pa.array(group)))
        for head, tail, n in spans.out():
            none, tail = tail == 0, np.maximum(tail, 1) - 1
            yield rows(SPAN, n, head=spans.names.take(pa.array(head)), tail=spans.names.take(pa.array(tail, mask=none)),
                       plain=pa.array(spans.plain[head] & (none | spans.plain[tail])))

    def lengths(texts: pa.Array, bare: pa.Array, state: np.ndarray, at: np.ndarray, per_row: np.ndarray, wanted: np.ndarray) -> pa.RecordBatch:
        one = state == PLAIN
        one |= (state == SURE) & ~pc.match_substring_regex(bare, _SPACES).to_numpy(zero_copy_only=False)
        ends = np.cumsum(per_row)
        upto = np.concatenate([[0], np.cumsum(one[at])])
        known = upto[ends] - upto[ends - per_row]
        open_ = np.flatnonzero((~one & (state != GONE))[at])
        offsets = np.searchsorted(open_, np.concatenate([[0], ends])).astype(np.int32)
        rest = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), bare.take(pa.array(at[open_]))), " ")
        rest = pc.if_else(pa.array(np.diff(offsets) > 0), rest, None)
        null = texts.is_null().to_numpy(zero_copy_only=False)
        return rows(LENGTH, pa.array(known, mask=null), head=rest).filter(pa.array(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, spans = _Counts(), _Counts()
        for b in batches:
            for lo, hi in parts(b.column(2)):
                part = b.slice(lo, hi - lo)
                wanted = (np.asarray(part.column(1)) & 1) > 0
                pieces_, per_row = cut(part.column(2))
                coded = pc.dictionary_encode(pieces_)
                at, bare = coded.indices.to_numpy(), pc.ascii_rtrim(coded.dictionary, " \n")
                clean, state = settle_eda(bare, words)
                yield lengths(part.column(2), bare, state, at, per_row, wanted)
                if not len(pieces_):
                    continue
                _add_pieces(held, [part.column(0), part.column(1)], coded, bare, per_row)
                _add_spans(spans, clean, np.where(np.repeat(wanted, per_row), state[at], GONE), at, per_row)
                if held.full() or spans.full():
                    yield from given(held, spans)
                    held, spans = _Counts(), _Counts()
        yield from given(held, spans)
    return run


def profile(df: DataFrame, text: Column, bare: Column, rating: Column, words: list[str]) -> DataFrame:
    """All that the profile tables need of the texts, in one pass over them; rows by ``kind``:

    * ``LENGTH``, one for each text: ``n`` tokens of the ``eda`` profile beside those of the pieces in ``head``.
    * ``PIECE``: ``head`` stands ``n`` times in texts with that ``rating``. ``use`` is 3 for texts that are the same with
      and without tags; the others are counted without tags (1, ``bare``) and with them (2).
    * ``SPAN``: as :func:`pairs_of` takes them, of the texts without tags."""
    ship(df.sparkSession)

    def form(use: int, c: Column) -> Column:
        return F.struct(rating.cast("double").alias("rating"), F.lit(use).alias("use"), c.alias("text"))
    forms = F.when(F.contains(text, F.lit("<")), F.array(form(1, bare), form(2, text))).otherwise(F.array(form(3, text)))
    rows = df.select(F.explode(forms).alias("r")).select("r.rating", "r.use", "r.text")
    return rows.mapInArrow(_profile(list(words)), _PROFILE)
