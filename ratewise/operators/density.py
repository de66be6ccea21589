"""Density filter: keep items and users with enough ratings (one pass, items first).

Counts are partial + final hash aggregates. The keep-sets are applied with ``left_semi`` joins
(the reference's inner join adds a count column that it drops again, so semi is equal). At
runtime AQE broadcasts a keep-set that is small, and otherwise splits skewed partitions of the
big side, so a product or user holding a large share of rows is spread over several tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import longtext, prep


def item_counts(df: DataFrame, min_ratings: int | None = None, item: str = "asin",
                rating: str = "overall") -> DataFrame:
    """A2: ``count(rating)`` per item (null ratings not counted), optionally ``>= min``."""
    out = df.groupBy(item).agg(F.count(rating).alias("num_ratings"))
    return out if min_ratings is None else out.where(F.col("num_ratings") >= min_ratings)


def user_counts(df: DataFrame, min_reviews: int | None = None, user: str = "reviewerID") -> DataFrame:
    """A3: ``count(*)`` per user, optionally ``>= min``."""
    out = df.groupBy(user).agg(F.count(F.lit(1)).alias("review_count"))
    return out if min_reviews is None else out.where(F.col("review_count") >= min_reviews)


def _keep(df: DataFrame, key: str, counts) -> DataFrame:
    """The rows of ``df`` whose key is left in ``counts``; their long texts do not meet the keep-set."""
    if not longtext.has_text(df):
        return df.join(counts(df).select(key), key, "left_semi")
    slim, texts = longtext.set_aside(df)
    return longtext.put_back(slim.join(counts(slim).select(key), key, "left_semi"), texts)


def keep_popular_items(df: DataFrame, min_ratings: int = 3, item: str = "asin") -> DataFrame:
    """Rows whose item has at least ``min_ratings`` ratings."""
    return _keep(df, item, lambda rows: item_counts(rows, min_ratings, item))


def keep_active_users(df: DataFrame, min_reviews: int = 3, user: str = "reviewerID") -> DataFrame:
    """Rows whose user has at least ``min_reviews`` rows in ``df``."""
    return _keep(df, user, lambda rows: user_counts(rows, min_reviews, user))


def density_filter(df: DataFrame, since_ts: int = prep.SINCE_2013, min_text: int = 5,
                   min_item_ratings: int = 3, min_user_reviews: int = 3) -> DataFrame:
    """F3 core: P4, P5, J1, J2 (J2 counts what J1 left), P7."""
    recent = prep.min_text_length(prep.since(df, since_ts), min_text)
    # counts and keep-sets see rows with digests; the texts are put back to the final rows
    slim, texts = longtext.set_aside(recent.select("reviewerID", "asin", "overall", "reviewText"))
    items = cut_lineage(item_counts(slim, min_item_ratings).select("asin"))
    popular = slim.join(items, "asin", "left_semi")
    users = user_counts(popular, min_user_reviews).select("reviewerID")
    kept = popular.join(users, "reviewerID", "left_semi")
    return longtext.put_back(kept.select("reviewerID", "asin", "overall", "reviewText"), texts)
