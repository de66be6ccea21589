"""User-facing jobs (F1-F8) composed from the operators. Counts that the reference printed
with one action each are gathered in the same pass as the write with ``DataFrame.observe``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import porter2
from ..functions import text as tx
from ..operators import cleaning, dedup, density, longtext, prep, stats, terms
from ..operators import recommend as rc
from ..schema import CLEAN_CONTRACT, FILTERED_CONTRACT, LOAD_CONTRACT
from ..session import cut_lineage, stored
from ..sources import reviews as io
from ..sources.contract import contract_reasons
from ..streaming import messages as ms

REQUIRED = ["asin", "overall", "reviewText", "reviewerID", "unixReviewTime"]


def load_job(spark: SparkSession, src: str, out: str, rejects: str | None = None) -> dict:
    """read JSON, drop incomplete rows and exact duplicates, check the contract, write. Nothing
    that is set aside is lost: malformed lines go to ``<rejects>/malformed``, rows that break the
    contract to ``<rejects>/contract`` (``<out>-rejects`` by default).

    The counts come from the pass that does the work: the malformed lines are counted as they are
    written; of the others each step's rows are observed while digests of their texts are stored, and
    the rejected ones while the good ones are written."""
    rejects = rejects or f"{out}-rejects"
    good, bad = io.read_reviews(spark, src, quarantine=True)
    seen = {name: Observation(name) for name in ("malformed", "read", "complete", "distinct", "rejected")}
    n = F.count(F.lit(1)).alias("n")
    bad.select("line").observe(seen["malformed"], n).write.mode("overwrite").parquet(f"{rejects}/malformed")
    complete = prep.drop_incomplete(good.observe(seen["read"], n)).observe(seen["complete"], n)
    # rows are compared by the digests of their texts, which are put back where rows are written; they are checked
    # before (a digest is null where the text is), so that only rows that are written meet their texts
    slim = complete.withColumn("reviewText", longtext.digest())
    distinct = stored(dedup.drop_exact_duplicates(slim).observe(seen["distinct"], n), "distinct")
    checked = distinct.withColumn("_reasons", contract_reasons(complete, LOAD_CONTRACT))
    texts = longtext.distinct_texts(prep.drop_incomplete(good))
    kept = checked.observe(seen["rejected"], F.count_if(F.size("_reasons") > 0).alias("n")).where(F.size("_reasons") == 0)
    longtext.put_back(kept.drop("_reasons"), texts).write.mode("overwrite").option("compression", "zstd").parquet(out)
    rejected = checked.where(F.size("_reasons") > 0).withColumn("reason", F.array_join("_reasons", "; ")).drop("_reasons")
    longtext.put_back(rejected, texts).write.mode("overwrite").parquet(f"{rejects}/contract")
    got = {name: o.get["n"] for name, o in seen.items()}
    return {"malformed": got["malformed"], "incomplete": got["read"] - got["complete"],
            "duplicates": got["complete"] - got["distinct"], "rejected": got["rejected"],
            "written": got["distinct"] - got["rejected"]}


def clean_reviews(df: DataFrame, stemmer: str = "plural") -> DataFrame:
    """F2 transform: required fields present, verified only, summary merged into the text, feedback
    label, one row per (asin, reviewer, time) - which exact duplicates share, so they need no step
    of their own -, vote parsed and filled with the global mean, text lower-cased, tokenised and
    stemmed.

    ``stemmer="plural"`` folds plurals token by token in place (no shuffle); ``"english"`` is the full
    English stemmer (T10): stems of the vocabulary, joined to the tokens."""
    if stemmer not in ("plural", "english"):
        raise ValueError(f"unknown stemmer {stemmer}")
    df = prep.drop_incomplete(df, REQUIRED)
    df = prep.label_feedback(prep.merge_summary(prep.only_verified(df)))
    df = prep.fill_vote_global(dedup.drop_duplicate_reviews_in_place(df))
    if stemmer == "plural":
        return cleaning.clean_texts(df, "reviewText", "stem")
    names = df.columns
    tokens = cut_lineage(df.withColumns({"_tokens": tx.tokenize(tx.lower("reviewText")), "_key": F.struct(*dedup.REVIEW_KEY)}).drop("reviewText"))
    mapped = terms.map_terms(tokens, "_key", "_tokens", porter2.english_mapping(terms.vocabulary(tokens, "_tokens")))
    return mapped.withColumn("reviewText", tx.join_tokens("_tokens")).select(*names)


def clean_load_job(spark: SparkSession, src: str, out: str, stemmer: str = "plural") -> DataFrame:
    """read, clean, check, write clustered by reviewer and indexed (fast per-user reads). Returns
    the rejected rows."""
    df = clean_reviews(io.read_reviews(spark, src), stemmer)
    return io.write_table(df, out, contract=CLEAN_CONTRACT, cluster_by="reviewerID", index=["reviewerID"])


def density_filter_job(spark: SparkSession, src: str, out: str, since_ts: int = prep.SINCE_2013,
                       min_ratings: int = 3) -> DataFrame:
    """stored reviews -> recent, long enough, popular items, active users -> write."""
    df = density.density_filter(io.read_table(spark, src), since_ts, 5, min_ratings, min_ratings)
    return io.write_table(df, out, contract=FILTERED_CONTRACT)


def eda_tables(df: DataFrame) -> dict[str, DataFrame]:
    """every profile table, lazily (each is small; run the ones you need)."""
    # the texts are gone through once for all tables that need them, and the other columns are stored without them
    texts = terms.text_profile(df)
    slim = stored(df.drop("reviewText"), "profile-columns")
    parsed = slim.withColumn("vote", prep.vote_number("vote"))
    numeric = [c for c in stats.numeric_column_names(parsed)]
    lengths = cut_lineage(texts["lengths"])  # one number a review
    scatter = stats.scatter_matrix(parsed)
    return {
        "describe": stats.describe_numeric(parsed),
        "info": stats.table_info(df),
        "review_length_histogram": stats.histogram(lengths, "length", 20),
        "review_length_kde": stats.kde(lengths, "length"),
        "vote_histogram": stats.histogram(parsed, "vote", 20),
        "vote_kde": stats.kde(parsed, "vote"),
        "top_terms_by_rating": terms.rank_top(texts["by_rating"], 20, ["term"], by=["overall"]),
        "verified_counts": stats.category_counts(slim, "verified"),
        "rating_histogram": stats.histogram(slim, "overall", 10),
        "mean_rating": stats.mean_rating(slim),
        "top_products": stats.value_counts_top(slim, "asin", 10),
        "best_rated": stats.best_rated(slim, 10),
        "worst_rated": stats.worst_rated(slim, 10),
        "best_products": stats.best_rated(slim, 10, by_product=True),
        "worst_products": stats.worst_rated(slim, 10, by_product=True),
        "term_cloud": terms.term_cloud_weights(df, "reviewText", 200, texts["pieces"]),
        "top_terms": terms.rank_top(texts["raw"], 20, ["term"]),
        "top_bigrams": terms.rank_top(texts["bigrams"].where("n >= 10"), 25, ["bigram"]),
        "correlation": stats.correlation_matrix(parsed, numeric),
        "scatter_cells": scatter["cells"],
        "scatter_diagonal": scatter["diagonal"],
    }


def notebook_clean(df: DataFrame) -> DataFrame:
    """F5 transform: raw-only columns out, empty text for null, summary merged, feedback, one
    row per key, vote parsed and filled by product mean (int), text cleaned (all sentences)."""
    df = df.drop(*[c for c in ("reviewerName", "image", "style") if c in df.columns])
    df = prep.label_feedback(prep.merge_summary(prep.fill_text(df)))
    slim, texts = longtext.set_aside(df)
    df = longtext.put_back(prep.fill_vote_by_product(dedup.drop_duplicate_reviews(slim, texts=texts)), texts)
    return cleaning.clean_texts(df, "reviewText", "notebook")


def notebook_tables(df: DataFrame) -> dict[str, DataFrame]:
    """F5 counts on the cleaned table."""
    return {
        "null_counts": stats.null_counts(df),
        "reviews_per_product": stats.reviews_per_product(df),
        "reviews_per_product_rating": stats.reviews_per_product_rating(df),
        "distinct_counts": stats.distinct_counts(df),
        "feedback_counts": stats.feedback_counts(df),
        "numeric_columns": prep.numeric_columns(df),
    }


def train_job(ratings: DataFrame, model_path: str | None = None, rank: int = 40, max_iter: int = 5,
              reg: float = 0.1, seed: int = 42):
    """ids, features, split, ALS fit, validation RMSE, save. The encoded table is
    stored so the iterative fit does not recompute the id assignment."""
    # the input and both id tables are read several times: materialise each once
    ratings = stored(ratings.select("reviewerID", "asin", "overall", "unixReviewTime"), "ratings")
    users = stored(rc.build_id_index(ratings, "reviewerID", "user"), "ids")
    items = stored(rc.build_id_index(ratings, "asin", "item"), "ids")
    enc, users, items = rc.interactions(ratings, users=users, items=items)
    enc = stored(rc.shuffle_split(enc, seed), "split")
    model = rc.fit_als(enc.where(F.col("split") == "train").select("user", "item", "y"), rank, max_iter, reg, seed)
    if model_path:
        io.save_model(model, f"{model_path}/als")
        users.write.mode("overwrite").parquet(f"{model_path}/users")
        items.write.mode("overwrite").parquet(f"{model_path}/items")
    return model, enc, users, items, rc.rmse(model, enc.where(F.col("split") == "val"))


def als_answers(model, enc: DataFrame, users: DataFrame, items: DataFrame, requested: DataFrame, k: int = 10) -> DataFrame:
    """(reviewerID, rank, asin, score, source): top-k unseen of the requested users (rows with the id
    ``user``), complete: a user that the model has not seen gets the fallback list."""
    uf, itf = rc.als_factors(model)
    recs = rc.recommend_all(requested, uf, itf, enc, rc.fallback_items(enc), k)
    named = rc.decode_ids(rc.decode_ids(recs, users, "reviewerID", "user"), items, "asin", "item")
    return named.select("reviewerID", "rank", "asin", F.round("score", 6).alias("score"), "source")


def recommend_job(model, enc: DataFrame, users: DataFrame, items: DataFrame, reviews: DataFrame,
                  requested: DataFrame, k: int = 10, publish_to: str | None = None, store: str | None = None,
                  run_id: str | None = None, fmt: str = "json"):
    """top-k unseen of the requested users, decoded; optionally published as messages and
    appended to the recommendation table under ``run_id``, which has no default: a run that is repeated
    under its id replaces its own rows, any other id adds to the table. Returns (recommendations,
    reviews of the recommended items)."""
    if store and not run_id:
        raise ValueError("storing recommendations needs the id of the run")
    recs = cut_lineage(als_answers(model, enc, users, items, requested, k))
    if publish_to:
        ms.publish(ms.encode_messages(recs), publish_to, fmt=fmt)
    if store:
        io.append_rows(recs, store, run_id)
    return recs, rc.reviews_of(reviews, recs.select("asin"), bounded=False)


def consume_job(spark: SparkSession, source: str, sink: str, checkpoint: str, fmt: str = "json",
                starting_offsets: str = "latest"):
    """F8: messages -> decoded rows (``<sink>/rows``) and rejected messages (``<sink>/rejects``), both
    in idempotent per-batch folders."""
    stream = ms.decode_messages(ms.consume(spark, source, fmt=fmt, starting_offsets=starting_offsets, checkpoint=checkpoint))
    return ms.sink_batches(stream, sink, checkpoint,
                           outputs={"rows": ms.explode_recommendations, "rejects": ms.rejected_messages})
