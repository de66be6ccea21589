"""Term statistics over token arrays: vocabulary, top terms, term-cloud weights, bigrams, and
term mapping (lemma, stem or spelling tables).

Counting aggregates in the tasks, so the shuffle carries one row per (task, term), not per token;
texts are cut and counted in Arrow columns (``pieces.py``), token arrays are exploded. Mappings are applied to the vocabulary (distinct terms)
and re-aggregated wherever only counts are needed.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..session import cut_lineage, ship, stored
from . import coded, pieces
from .stats import top_k_per_group


def vocabulary(df: DataFrame, tokens: str = "tokens", by: list[str] | None = None,
               term: str = "term") -> DataFrame:
    """(by..., term, n)."""
    by = by or []
    # explode_outer: a plain explode makes Catalyst infer ``size(tokens) > 0`` and push it below
    # joins, which evaluates the whole cleaning chain twice.
    return (df.select(*by, F.explode_outer(tokens).alias(term)).where(F.col(term).isNotNull())
            .groupBy(*by, term).agg(F.count(F.lit(1)).alias("n")))


def term_counts(df: DataFrame, text: str, profile: str = "eda", by: list[str] | None = None,
                stem: bool = True, words=None, term: str = "term") -> DataFrame:
    """T13 straight from text: (by..., term, n), equal to counting :func:`text.clean_tokens`.

    The text itself is only cut at blanks and line feeds (tags are removed first where there is a
    ``<`` at all) and the pieces are counted, in Arrow columns (``pieces.py``); all other steps - deletions, other white space,
    lower case, stop words, stemmer -, which look at single characters or words, work once per distinct
    piece and group; the counts are added up again."""
    by = by or []
    return counts_of_pieces(pieces.piece_counts(df, tx.untagged(text, profile), by, term), profile, by, stem, words, term)


def counts_of_pieces(raw: DataFrame, profile: str = "eda", by: list[str] | None = None, stem: bool = True, words=None, term: str = "term") -> DataFrame:
    """The second half of :func:`term_counts`, from the counts of pieces (by..., term, n)."""
    from ..functions.stopwords import ENGLISH
    by = by or []
    words = ENGLISH if words is None else words
    t = F.col(term)
    low = raw.select(*by, F.explode(tx.blank_split(tx.prepared_piece(t, profile))).alias(term), "n").where(t != "")
    low = low.select(*by, F.lower(t).alias(term), "n")
    if profile in ("eda", "raw"):
        low = low.where(~t.isin(list(words)))
    if stem and profile in ("eda", "stem"):
        low = low.select(*by, tx.s_stem(t).alias(term), "n")
    return low.groupBy(*by, term).agg(F.sum("n").alias("n"))


def rank_top(counts: DataFrame, k: int, order_cols: list[str], by: list[str] | None = None,
             rank_col: str = "rank") -> DataFrame:
    """Top ``k`` rows by count (ties by ``order_cols``), per group when ``by`` is given."""
    order = [F.desc("n")] + [F.asc(c) for c in order_cols]
    if by:
        return top_k_per_group(counts, by, order, k, rank_col)
    top = counts.orderBy(*order).limit(k)
    # at most k rows: the window below sorts a bounded set
    return top.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)))


def top_terms(df: DataFrame, tokens: str = "tokens", k: int = 20, by: list[str] | None = None) -> DataFrame:
    """The ``k`` most common terms (per group), ties by term."""
    return rank_top(vocabulary(df, tokens, by), k, ["term"], by)


def fold_plurals(counts: DataFrame, word: str = "word") -> DataFrame:
    """(word, n) with a word in -s (not -ss) added to its form without the s where that occurs."""
    plural = F.col(word).endswith("s") & ~F.col(word).endswith("ss")
    single = F.when(plural, F.col(word).substr(F.lit(1), F.length(word) - 1))
    other = counts.select(F.col(word).alias("_single"))
    folded = counts.withColumn("_to", single).join(other, F.col("_to") == F.col("_single"), "left")
    return (folded.select(F.coalesce("_single", word).alias(word), "n")
            .groupBy(word).agg(F.sum("n").alias("n")))


def term_cloud_weights(df: DataFrame, text: str = "reviewText", k: int = 200, counted: DataFrame | None = None) -> DataFrame:
    """The ``k`` most frequent cloud words with weight ``n / max(n)``. Numbers are left out and
    plurals folded; word pairs are not counted. ``counted`` has the pieces of the texts (piece, n), where they are counted."""
    from ..functions.stopwords import ENGLISH
    # blank-cut pieces are counted first, then raw words: no word goes over a blank. Possessives, numbers
    # and stop words are seen to once per word
    counted = pieces.piece_counts(df, F.col(text), term="piece") if counted is None else counted
    raw = (counted.select(F.explode(tx.cloud_words("piece")).alias("w"), "n")
           .groupBy("w").agg(F.sum("n").alias("n")))
    words = (raw.select(F.regexp_replace("w", "'s$", "").alias("word"), "n")
             .where(~F.col("word").rlike(f"^{tx.DIGITS_PATTERN}$") & ~F.col("word").isin(ENGLISH)))
    # both sides of the fold read the words: the texts are gone through once
    counts = fold_plurals(cut_lineage(words.groupBy("word").agg(F.sum("n").alias("n"))))
    top = rank_top(counts, k, ["word"])
    peak = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return top.withColumn("weight", F.round(F.col("n") / F.max("n").over(peak), 6))


#: A word pair stands in the cloud as one entry if its likelihood ratio is above this (fixed value).
PAIR_SCORE = 30.0


def term_cloud_pairs(df: DataFrame, text: str = "reviewText", k: int = 200, least: float = PAIR_SCORE) -> DataFrame:
    """T16 with word pairs: (word, n, rank, weight) of the ``k`` heaviest entries, words and pairs.

    Words are those of :func:`term_cloud_weights`, in order, stop words and numbers left out (two words
    with only such words between them are no neighbours). A pair whose Dunning ratio is above ``least``
    is an entry of its own, and its occurrences are taken away from both of its words. Pairs are counted
    map-side on raw words; plurals are folded on distinct words and pairs."""
    from ..functions.stopwords import ENGLISH
    from .sentences import log_likelihood
    raw = pieces.neighbour_counts(df, F.col(text), pieces.settle_cloud, tx.cloud_words, [])
    raw = cut_lineage(raw.groupBy("a", "b").agg(F.sum("n").alias("n")))

    def word(c: str):
        w = F.when(F.col(c).endswith("'s"), F.expr(f"left({c}, length({c}) - 2)")).otherwise(F.col(c))
        # a word that begins with a letter is no number: the pattern is for the others
        number = F.when(w.substr(1, 1).between("a", "z"), False).otherwise(w.rlike(f"^{tx.DIGITS_PATTERN}$"))
        return F.when(~number & ~w.isin(ENGLISH), w)

    named = raw.select(word("a").alias("a"), word("b").alias("b"), "n")
    words = named.where("a IS NOT NULL").groupBy(F.col("a").alias("word")).agg(F.sum("n").alias("n"))
    words = cut_lineage(words)
    plural = F.col("word").endswith("s") & ~F.col("word").endswith("ss")
    single = words.withColumn("to", F.when(plural, F.expr("left(word, length(word) - 1)")))
    folds = single.join(words.select(F.col("word").alias("to")), "to", "left_semi").select("word", "to")
    one = map_vocabulary(words.withColumnRenamed("word", "term"), folds.select(F.col("word").alias("term"), F.col("to").alias("replacement")))
    one = cut_lineage(one.withColumnRenamed("term", "word"))
    two = named.where("a IS NOT NULL AND b IS NOT NULL").groupBy("a", "b").agg(F.sum("n").alias("n"))
    for side in ("a", "b"):
        two = (two.join(folds.select(F.col("word").alias(side), F.col("to").alias(f"to_{side}")), side, "left")
               .withColumn(side, F.coalesce(f"to_{side}", side)).drop(f"to_{side}"))
    two = two.groupBy("a", "b").agg(F.sum("n").alias("n"))
    total = one.select(F.sum("n")).scalar()
    scored = (two.join(one.select(F.col("word").alias("a"), F.col("n").alias("n_a")), "a")
              .join(one.select(F.col("word").alias("b"), F.col("n").alias("n_b")), "b"))
    kept = cut_lineage(scored.where((F.col("n_a") < total) & (F.col("n_b") < total)
                                    & (log_likelihood(F.col("n"), F.col("n_a"), F.col("n_b"), total) > least)).select("a", "b", "n"))
    taken = (kept.select(F.col("a").alias("word"), "n").union(kept.select(F.col("b").alias("word"), "n"))
             .groupBy("word").agg(F.sum("n").alias("t")))
    rest = one.join(taken, "word", "left").select("word", (F.col("n") - F.coalesce("t", F.lit(0))).alias("n")).where("n > 0")
    entries = rest.unionByName(kept.select(F.concat_ws(" ", "a", "b").alias("word"), "n"))
    top = rank_top(entries, k, ["word"])
    peak = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return top.withColumn("weight", F.round(F.col("n") / F.max("n").over(peak), 6))


def bigram_counts(df: DataFrame, text: str, words=None) -> DataFrame:
    """T17 straight from text: (bigram, n), equal to counting the pairs of ``clean_tokens(text, "eda")``.
    Pairs are counted before they are stemmed; the stemmer makes one token of each."""
    from ..functions.stopwords import ENGLISH
    words = list(ENGLISH if words is None else words)
    pairs = pieces.neighbour_counts(df, tx.untagged(text, "eda"), pieces.settle_eda,
                                    lambda c: tx.untagged_tokens(c, words), words)
    return _stemmed_pairs(pairs)


def _stemmed_pairs(pairs: DataFrame) -> DataFrame:
    return (pairs.where("b IS NOT NULL").select(F.concat(tx.s_stem(F.col("a")), F.lit(" "), tx.s_stem(F.col("b"))).alias("bigram"), "n")
            .groupBy("bigram").agg(F.sum("n").alias("n")))


def top_bigrams(df: DataFrame, tokens: str = "tokens", k: int = 25, min_count: int = 10, text: str | None = None) -> DataFrame:
    """Adjacent pairs within a text seen at least ``min_count`` times, top ``k``. With ``text`` the
    tokens are those of the ``eda`` profile of that column, counted by :func:`bigram_counts`."""
    if text is not None:
        counts = bigram_counts(df, text)
    else:
        counts = vocabulary(df.select(tx.bigrams(tokens).alias("pairs")), "pairs", term="bigram")
    return rank_top(counts.where(F.col("n") >= min_count), k, ["bigram"])


def text_profile(df: DataFrame, text: str = "reviewText", rating: str = "overall") -> dict[str, DataFrame]:
    """What the profile job needs of the texts, all made in one pass over them and stored: ``lengths`` (length: tokens of
    the ``eda`` profile), ``by_rating`` (overall, term, n: its terms in texts rated 1 to 5), ``raw`` (term, n), ``pieces`` (piece,
    n: for the term cloud) and ``bigrams`` (bigram, n)."""
    from ..functions.stopwords import ENGLISH
    rated = F.when(F.col(rating).isin(1, 2, 3, 4, 5), F.col(rating))
    rows = stored(pieces.profile(df, F.col(text), tx.untagged(text, "eda"), rated, list(ENGLISH)), "profile")
    # what a session says of the length of null is asked of it
    none = F.size(F.lit(None).cast("array<string>"))
    more = F.when(F.col("head").isNotNull(), F.size(tx.untagged_tokens("head"))).otherwise(F.lit(0))
    lengths = rows.where(F.col("kind") == pieces.LENGTH).select(F.when(F.col("n").isNull(), none).otherwise(F.col("n") + more).cast("double").alias("length"))
    found = rows.where(F.col("kind") == pieces.PIECE)
    by_rating = (found.where("use <> 2 AND rating IS NOT NULL").groupBy(F.col("rating").cast(df.schema[rating].dataType).alias(rating), F.col("head").alias("term"))
                 .agg(F.sum("n").alias("n")))
    whole = found.where("use <> 1").groupBy(F.col("head").alias("term")).agg(F.sum("n").alias("n"))
    spans = rows.where(F.col("kind") == pieces.SPAN).select("head", "tail", "plain", "n")
    return {"lengths": lengths, "by_rating": counts_of_pieces(by_rating, "eda", [rating]), "raw": counts_of_pieces(whole, "raw"),
            "pieces": whole.withColumnRenamed("term", "piece"), "bigrams": _stemmed_pairs(pieces.pairs_of(spans, tx.untagged_tokens))}


def stem_mapping(vocab: DataFrame, term: str = "term") -> DataFrame:
    """Default (term, replacement) table: the S stemmer over distinct terms."""
    return vocab.select(term).distinct().select(F.col(term).alias("term"),
                                                tx.s_stem(F.col(term)).alias("replacement"))


def map_vocabulary(counts: DataFrame, mapping: DataFrame, by: list[str] | None = None) -> DataFrame:
    """T9-T11 on counts: replace each term by its mapping (unmapped terms stay) and add up.
    ``mapping`` is (term, replacement) with unique term; AQE broadcasts it when it is small."""
    by = by or []
    mapped = counts.join(mapping, "term", "left").select(
        *by, F.coalesce(F.col("replacement"), F.col("term")).alias("term"), "n")
    return mapped.groupBy(*by, "term").agg(F.sum("n").alias("n"))


def normaliser_mapping(vocab: DataFrame, make, term: str = "term") -> DataFrame:
    """(term, replacement) from a Python normaliser, run once per distinct term.

    ``make()`` returns the function ``str -> str``; it is called once per task, before the first
    batch, so models or dictionaries are loaded there and not per word. Terms come in Arrow batches.
    A null result leaves the term as it is (see :func:`map_vocabulary`, :func:`map_terms`)."""
    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fn = make()
        for words in batches:
            yield pd.Series([fn(w) for w in words], dtype=object)

    ship(vocab.sparkSession)
    distinct = cut_lineage(vocab.select(F.col(term).alias("term")).where(F.col(term).isNotNull()).distinct())
    return cut_lineage(distinct.select("term", run("term").alias("replacement")))


def map_terms(df: DataFrame, key: str, tokens: str, mapping: DataFrame, out: str | None = None) -> DataFrame:
    """T9-T11 on token arrays with a user table: the distinct terms of each chunk of rows are left-joined to
    the mapping, and the arrays are rebuilt from their codes (``coded.py``); no token becomes a row.

    Rows of the same key have the terms of all of them, by position and term; a null key has none."""
    out = out or tokens
    others = [c for c in df.columns if c not in (key, out)]
    df = df.select(key, *others, F.when(F.col(key).isNotNull(), F.col(tokens)).alias("_tokens"))
    rows, found = coded.encode(df, "_tokens")
    words = found.join(mapping.select("term", "replacement"), "term", "left").select(
        "_chunk", "_code", F.coalesce(F.col("replacement"), F.col("term")).alias("_word"))
    mapped = coded.decode(rows, words, out)
    twice = cut_lineage(rows.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").select(key))
    if twice.isEmpty():
        return mapped
    again = (mapped.join(twice, key, "left_semi").select(key, F.posexplode(out).alias("pos", "term"))
             .groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "term"))).alias("_p")))
    again = again.select(key, F.transform("_p", lambda s: s["term"]).alias("_all"))
    return mapped.join(again, key, "left").withColumn(out, F.coalesce("_all", out)).drop("_all")
