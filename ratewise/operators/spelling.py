"""Spelling correction against the corpus's own frequent words.

A rare term (count below ``min_count``) is replaced by the most frequent frequent term within
one edit (delete, insert, replace or swap adjacent characters); ties go to the smaller term; a
rare term with no such neighbour stays. Two terms one edit apart share a key among themselves and
their strings with one character deleted, so both sides emit length + 1 keys per term and are
equi-joined on them; the edit is then checked on the pair. No alphabet, no all-pairs work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def deletion_keys(df: DataFrame, term: str, key: str = "key") -> DataFrame:
    """``df`` with one row per distinct key of ``term``: the term and each one-character deletion."""
    t = F.col(term)
    drop = F.transform(F.sequence(F.lit(1), F.length(t)),
                       lambda i: F.concat(t.substr(F.lit(1), i - 1), t.substr(i + 1, F.length(t))))
    keys = F.when(F.length(t) == 0, F.array(t)).otherwise(F.array_distinct(F.concat(F.array(t), drop)))
    return df.select("*", F.explode(keys).alias(key))


def one_edit(a, b) -> F.Column:
    """Whether two terms are one deletion, insertion, replacement or adjacent swap apart."""
    swapped = F.exists(F.sequence(F.lit(1), F.greatest(F.length(a) - 1, F.lit(1))), lambda i: F.concat(
        a.substr(F.lit(1), i - 1), a.substr(i + 1, F.lit(1)), a.substr(i, F.lit(1)), a.substr(i + 2, F.length(a))) == b)
    return (F.levenshtein(a, b) == 1) | ((F.length(a) == F.length(b)) & (F.length(a) > 1) & (a != b) & swapped)


def spelling_mapping(counts: DataFrame, min_count: int = 5, term: str = "term") -> DataFrame:
    """(term, replacement) for rare terms that have a frequent neighbour."""
    counts = cut_lineage(counts.select(term, "n"))
    frequent = counts.where(F.col("n") >= min_count).select(F.col(term).alias("variant"), F.col("n").alias("fn"))
    rare = counts.where(F.col("n") < min_count).select(term)
    pairs = (deletion_keys(rare, term).hint("merge").join(deletion_keys(frequent, "variant"), "key")
             .where(one_edit(F.col(term), F.col("variant"))))
    # a pair that shares several keys is harmless: the best neighbour is a minimum
    best = pairs.groupBy(term).agg(F.min(F.struct((-F.col("fn")).alias("k"), F.col("variant").alias("v"))).alias("b"))
    return best.select(term, F.col("b.v").alias("replacement"))
