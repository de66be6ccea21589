"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. A word may be cut
into pieces in many ways; its probability in a language is the sum over all of them, by the
forward algorithm. A text's score is the product over its words. The piece probabilities are
learned by expectation-maximisation over the same segmentations.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType
from pyspark.sql.window import Window

from .common import ship, stored

#: The model is fitted on at most so many documents of each language (those with the smallest
#: hash of their key); every document is scored.
FIT_DOCS = 1000
ROUNDS = 3
#: Words are cut into stretches of at most so many letters, so that probabilities fit a double.
LONGEST = 32
#: Probability of a letter that the vocabulary lacks, the same in every language.
UNKNOWN = 1e-7
#: Weight, in pieces, of the pooled probabilities in each language's.
POOL = 200.0
UNDETERMINED = "und"

_LETTERS = re.compile(r"[^\W\d_]+")
_MARK = "▁"


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters."""
    if not text:
        return []
    return _LETTERS.findall(unicodedata.normalize("NFC", text).lower())


def stretches(word: str) -> list[str]:
    word = _MARK + word
    return [word[i:i + LONGEST] for i in range(0, len(word), LONGEST)]


_A = np.uint64(0x9E3779B97F4A7C15)
_BITS = 20


def _extend(h: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """Hashes of strings that are one letter longer."""
    h = (h + letters + np.uint64(1)) * _A
    return h ^ (h >> np.uint64(29))


class Pieces:
    """The numbers of the vocabulary's pieces by 64-bit hashes of their letters, for many strings at
    once. ``none`` is the number of what is no piece, ``none + 1`` that of a letter that is none."""

    def __init__(self, pieces: dict[str, int]):
        self.pieces, self.none = pieces, len(pieces)
        self.longest = max(map(len, pieces), default=1)
        h, ids = [np.empty(0, np.uint64)], [np.empty(0, np.int32)]
        for n in {len(x) for x in pieces}:
            some = [x for x in pieces if len(x) == n]
            letters = np.frombuffer("".join(some).encode("utf-32-le"), "<u4").astype(np.uint64).reshape(-1, n)
            one = np.zeros(len(some), np.uint64)
            for k in range(n):
                one = _extend(one, letters[:, k])
            h.append(one)
            ids.append(np.array([pieces[x] for x in some], np.int32))
        h, ids = np.concatenate(h), np.concatenate(ids)
        order = np.argsort(h)
        self.hashes, self.ids = h[order], ids[order]
        self.some = np.zeros(1 << _BITS, bool)  # most strings are no pieces: one look tells
        self.some[(h >> np.uint64(64 - _BITS)).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> np.ndarray:
        out = np.full(len(h), self.none, np.int32)
        maybe = np.flatnonzero(self.some[(h >> np.uint64(64 - _BITS)).astype(np.int64)])
        if len(maybe):
            at = np.minimum(np.searchsorted(self.hashes, h[maybe]), len(self.hashes) - 1)
            out[maybe] = np.where(self.hashes[at] == h[maybe], self.ids[at], self.none)
        return out


class Lattice:
    """All segmentations of words of one length: ``ids[:, j, k]`` are the pieces of the words that
    start at ``j`` and have ``k + 1`` letters."""

    def __init__(self, words: list[str], pieces: Pieces):
        n = len(words[0])
        self.n, self.longest = n, min(pieces.longest, n)
        letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64).reshape(len(words), n)
        self.ids = np.full((len(words), n, self.longest), pieces.none, np.int32)
        for j in range(n):
            h = np.zeros(len(words), np.uint64)
            for k in range(min(self.longest, n - j)):
                h = _extend(h, letters[:, j + k])
                found = pieces.find(h)
                self.ids[:, j, k] = np.where(found == pieces.none, pieces.none + 1, found) if k == 0 else found

    def forward(self, p: np.ndarray) -> np.ndarray:
        """[word, end, language]: summed probability of all segmentations of the first letters."""
        a = np.zeros((len(self.ids), self.n + 1, p.shape[1]))
        a[:, 0] = 1
        for j in range(self.n):
            for k in range(min(self.longest, self.n - j)):
                a[:, j + k + 1] += a[:, j] * p[self.ids[:, j, k]]
        return a

    def backward(self, p: np.ndarray) -> np.ndarray:
        b = np.zeros((len(self.ids), self.n + 1, p.shape[1]))
        b[:, self.n] = 1
        for j in reversed(range(self.n)):
            for k in range(min(self.longest, self.n - j)):
                b[:, j] += b[:, j + k + 1] * p[self.ids[:, j, k]]
        return b

    def expected(self, p: np.ndarray, counts: np.ndarray, into: np.ndarray) -> None:
        """Add to ``into`` the expected piece counts of the words, seen ``counts[word, language]`` times."""
        a, b = self.forward(p), self.backward(p)
        scale = counts / a[:, self.n]
        for j in range(self.n):
            for k in range(min(self.longest, self.n - j)):
                ids = self.ids[:, j, k]
                np.add.at(into, ids, a[:, j] * p[ids] * b[:, j + k + 1] * scale)


def lattices(words: list[str], pieces: Pieces, most: int = 2048):
    """(positions, lattice) for groups of words of equal length."""
    by: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        by.setdefault(len(w), []).append(i)
    for some in by.values():
        for i in range(0, len(some), most):
            at = some[i:i + most]
            yield at, Lattice([words[x] for x in at], pieces)


class Model:
    """Piece probabilities ``p[piece, language]``, with a memory of scored words."""

    def __init__(self, pieces: dict[str, int], langs: list[str], p: np.ndarray, letters: list[str] | None = None, most: int = 800_000):
        self.pieces, self.langs, self.p = pieces, langs, p
        #: by language: the letters of the texts it was fitted on
        self.letters = letters or [""] * len(langs)
        self.own = {lang: set(x) for lang, x in zip(langs, self.letters)}
        #: words held: the table and the words themselves take about 64 MB at most, whatever the languages
        self.most = min(most, (64 << 20) // (8 * max(len(langs), 1) + 120))
        self.index = Pieces(pieces)
        self.forget()

    def forget(self):
        self.known: dict[str, int] = {}
        self.table = np.empty((1024, len(self.langs)))

    def learn(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.known]
        if not new:
            return
        parts, owner = [], []
        for i, w in enumerate(new):
            for s in stretches(w):
                parts.append(s)
                owner.append(i)
        logs = np.empty((len(parts), len(self.langs)))
        for at, lattice in lattices(parts, self.index):
            logs[at] = np.log(lattice.forward(self.p)[:, -1])
        total = np.zeros((len(new), len(self.langs)))
        np.add.at(total, owner, logs)
        first = len(self.known)
        while first + len(new) > len(self.table):
            self.table = np.concatenate([self.table, np.empty_like(self.table)])
        self.table[first:first + len(new)] = total
        self.known.update(zip(new, range(first, first + len(new))))

    def predict(self, texts: list[str | None]) -> Iterator[tuple[str, float]]:
        """(language, posterior probability under equal priors) of each text."""
        if len(self.known) > self.most:
            self.forget()
        words = [words_of(t) for t in texts]
        if self.langs:
            self.learn({x for w in words for x in w})
        for w in words:
            if not self.langs or not any(c.isalpha() for x in w for c in x):
                yield UNDETERMINED, 0.0
                continue
            known = self.known
            ll = self.table[[known[x] for x in w]].sum(axis=0)
            ll -= ll.max()
            best = int(np.argmax(ll))
            yield self.langs[best], float(1 / np.exp(ll).sum())


    def familiar(self, text: str | None, lang: str) -> float:
        """The share of a text's letters that stand in texts of the language: an absolute measure, where
        the posterior only compares the languages that were learned."""
        low = unicodedata.normalize("NFC", text or "").lower()
        counts = {c: low.count(c) for c in set(low) if c.isalpha()}
        own = self.own.get(lang, ())
        return sum(n for c, n in counts.items() if c in own) / max(sum(counts.values()), 1)


def vocabulary(path: str) -> list[str]:
    """The pieces of a public sentencepiece model, without its control and byte pieces."""
    import sentencepiece

    s = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (s.id_to_piece(i) for i in range(s.get_piece_size())
              if not (s.is_control(i) or s.is_byte(i) or s.is_unknown(i)))
    return sorted({x.lower() for x in pieces})


def fit_rows(docs: DataFrame, key: str, text: str, lang: str, per_lang: int) -> DataFrame:
    """(lang, text) of at most ``per_lang`` documents of each language, those with the smallest hash
    of their key. Each language is first thinned to about four times as many by a bound on the hash
    that follows from its count, so the ranking of a common language is a small task."""
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(key).isNotNull())
    keys = rows.select(F.col(key).alias("key"), F.col(lang).alias("lang"),
                       (F.pmod(F.xxhash64(key), F.lit(1 << 31)) / float(1 << 31)).alias("h"))
    share = stored(keys.groupBy("lang").agg(F.least(F.lit(4.0 * per_lang + 64) / F.count("*"), F.lit(1.0)).alias("share")), "shares")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "key"))
    chosen = (keys.join(share, "lang").where("h <= share")
              .withColumn("rank", rank).where(F.col("rank") <= per_lang).select("key", "lang"))
    chosen = stored(chosen, "chosen").withColumnsRenamed({"key": "k", "lang": "l"})
    return rows.join(chosen, (rows[key] == chosen["k"]) & (rows[lang] == chosen["l"]), "left_semi").select(
        F.col(lang).alias("lang"), F.col(text).alias("text"))


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for lang, some in b.groupby("lang"):
            n = Counter(s for t in some["text"] for w in words_of(t) for s in stretches(w))
            yield pd.DataFrame({"lang": lang, "word": list(n), "n": list(n.values())})


def _expect(shared):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pieces, langs, p = shared.value
        index, known = {x: i for i, x in enumerate(langs)}, Pieces(pieces)
        into = np.zeros_like(p)
        for b in batches:
            words, at = np.unique(b["word"].to_numpy(object), return_inverse=True)
            counts = np.zeros((len(words), len(langs)))
            np.add.at(counts, (at, b["lang"].map(index).to_numpy()), b["n"].to_numpy())
            for some, lattice in lattices(list(words), known):
                lattice.expected(p, counts[some], into)
        i, j = np.nonzero(into[:len(pieces)])
        yield pd.DataFrame({"piece": i, "lang": j, "n": into[i, j]})
    return run


def _probabilities(counts: np.ndarray) -> np.ndarray:
    """Smoothed probabilities, then the rows for no piece (0) and for an unknown letter."""
    size = len(counts)
    pooled = (counts / np.maximum(counts.sum(axis=0), 1e-9)).mean(axis=1) + 0.01 / size
    pooled /= pooled.sum()
    p = (counts + POOL * pooled[:, None]) / (counts.sum(axis=0) + POOL)
    extra = np.zeros((2, counts.shape[1]))
    extra[1] = UNKNOWN
    return np.concatenate([p, extra])


def fit(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", lang: str = "lang",
        per_lang: int = FIT_DOCS, rounds: int = ROUNDS) -> Model:
    """A model of the languages of ``docs``. The word counts and the expectation step run on
    Spark; the driver holds one number per piece and language. Rows with a null key, text or
    language are not used; without any other row the model knows no language."""
    spark = docs.sparkSession
    ship(spark)
    pieces = {x: i for i, x in enumerate(vocabulary(path))}
    rows = fit_rows(docs, key, text, lang, per_lang)
    seen = stored(rows.mapInPandas(_count, "lang string, word string, n long")
                  .groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    langs = [r["lang"] for r in seen.select("lang").distinct().orderBy("lang").collect()]
    if not langs:
        return Model(pieces, [], np.zeros((len(pieces) + 2, 0)))
    p = _probabilities(np.ones((len(pieces), len(langs))))
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast((pieces, langs, p))
        got = (seen.mapInPandas(_expect(shared), "piece int, lang int, n double")
               .groupBy("piece", "lang").agg(F.sum("n").alias("n")).toPandas())
        counts = np.zeros((len(pieces), len(langs)))
        counts[got["piece"], got["lang"]] = got["n"]
        p = _probabilities(counts)
    letters = seen.select("lang", F.explode(F.array_distinct(F.split("word", ""))).alias("c")).groupBy("lang").agg(F.collect_set("c").alias("cs"))
    own = {r["lang"]: "".join(sorted(c for c in r["cs"] if c.isalpha())) for r in letters.collect()}  # an alphabet a language
    return Model(pieces, langs, p, [own.get(x, "") for x in langs])


_MODELS: dict[str, Model] = {}


def _score(shared, keep, text, familiar):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _MODELS.get(shared.value[0])
        if model is None:  # one model at a time, with its memory, for all tasks of a worker
            _MODELS.clear()
            model = _MODELS[shared.value[0]] = Model(*shared.value[1:])
        for b in batches:
            texts = b.column(text).to_pylist()
            got = [x for i in range(0, len(texts), 256) for x in model.predict(texts[i:i + 256])]
            columns = [b.column(c) for c in keep]
            columns += [pa.array([x for x, _ in got], pa.string()), pa.array([s for _, s in got], pa.float64())]
            if familiar:
                columns.append(pa.array([model.familiar(t, x) for t, (x, _) in zip(texts, got)], pa.float64()))
            yield pa.RecordBatch.from_arrays(columns, [*keep, "lang_pred", "score", *["familiar"] * familiar])
    return run


def identify(docs: DataFrame, model: Model, keep: list[str] | None = None, text: str = "text", familiar: bool = False) -> DataFrame:
    """The columns ``keep`` (``doc_id`` by default), ``lang_pred`` and ``score``, one row per row of
    ``docs``: a language of the model and its posterior probability; ``und`` and 0 if the text is
    null or has no letter, or the model knows no language. Ties go to the first language by name. With
    ``familiar`` there is a column of that name: the share of the text's letters that the predicted
    language has, which is near 0 for a script that was not learned, however sure the score.
    Null keys and repeated rows are scored like any other. Columns of ``docs`` called ``lang_pred``
    or ``score`` are replaced, other columns are ignored."""
    import uuid

    spark = docs.sparkSession
    ship(spark)
    added = ["lang_pred", "score", *["familiar"] * familiar]
    keep = [c for c in keep or ["doc_id"] if c not in added]
    shared = spark.sparkContext.broadcast((uuid.uuid4().hex, model.pieces, model.langs, model.p, model.letters))
    schema = StructType([*[docs.schema[c] for c in keep], *[StructField(c, StringType() if c == "lang_pred" else DoubleType()) for c in added]])
    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(_score(shared, keep, text, familiar), schema)
