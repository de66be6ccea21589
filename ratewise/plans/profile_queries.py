"""Registered queries for loading, cleaning, density filtering and profiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dedup, density, prep, stats
from ..schema import REVIEW_COLUMNS
from ..sources.fixtures import reviews_view
from .registry import oracle, query

# The fixture's ship dates end in 2001; the density filter uses 2001-01-01 as its cut-off on
# them (the reference's own default, 2013-01-01, is prep.SINCE_2013).
FIXTURE_SINCE = 978307200

KEY = ["asin", "reviewerID", "unixReviewTime"]
NO_TEXT = ["asin", "reviewerID", "overall", "verified", "summary", "unixReviewTime", "vote"]


def R(spark, sf, text=False):
    return reviews_view(spark, sf, with_text=text)


def _no_text_sql(alias=""):
    return ", ".join(f"{alias}{c}" for c in NO_TEXT)


@query("density_filter", oracle(f"""
WITH recent AS (SELECT * FROM reviews WHERE unixReviewTime >= {FIXTURE_SINCE} AND length(reviewText) >= 5),
items AS (SELECT asin FROM recent GROUP BY asin HAVING count(overall) >= 3),
j1 AS (SELECT * FROM recent WHERE asin IN (SELECT asin FROM items)),
users AS (SELECT reviewerID FROM j1 GROUP BY reviewerID HAVING count(*) >= 3)
SELECT reviewerID, asin, overall, reviewText FROM j1 WHERE reviewerID IN (SELECT reviewerID FROM users)
""", text=True))
def q_density_filter(spark, sf):
    return density.density_filter(R(spark, sf, True), since_ts=FIXTURE_SINCE)


@query("item_counts", oracle("""
SELECT asin, count(overall) AS num_ratings FROM reviews GROUP BY asin HAVING count(overall) >= 30"""))
def q_item_counts(spark, sf):
    return density.item_counts(R(spark, sf), 30)


@query("user_counts", oracle("""
SELECT reviewerID, count(*) AS review_count FROM reviews GROUP BY reviewerID HAVING count(*) >= 42"""))
def q_user_counts(spark, sf):
    return density.user_counts(R(spark, sf), 42)


_TEXT_OUT = "asin, reviewerID, overall, verified, summary, unixReviewTime, vote, md5(reviewText) AS text_md5"


def _text_out(df):
    return df.select(*NO_TEXT, F.md5("reviewText").alias("text_md5"))


@query("popular_item_rows", oracle(f"""
SELECT {_TEXT_OUT} FROM reviews
WHERE asin IN (SELECT asin FROM reviews GROUP BY asin HAVING count(overall) >= 32)""", text=True))
def q_popular_item_rows(spark, sf):
    return _text_out(density.keep_popular_items(R(spark, sf, True), 32))


@query("active_user_rows", oracle(f"""
SELECT {_TEXT_OUT} FROM reviews
WHERE reviewerID IN (SELECT reviewerID FROM reviews GROUP BY reviewerID HAVING count(*) >= 45)""", text=True))
def q_active_user_rows(spark, sf):
    return _text_out(density.keep_active_users(R(spark, sf, True), 45))


@query("row_count", oracle("SELECT count(*) AS rows FROM reviews"))
def q_row_count(spark, sf):
    return stats.row_count(R(spark, sf))


@query("table_shape", oracle("SELECT count(*) AS rows, 8 AS columns FROM reviews"))
def q_table_shape(spark, sf):
    return stats.table_shape(R(spark, sf))


def _per_column_sql(expr_of, extra=lambda i, c: ""):
    parts = [f"SELECT {i + 1} AS position, '{c}' AS column_name, {extra(i, c)}{expr_of(c)} FROM reviews"
             for i, c in enumerate(REVIEW_COLUMNS)]
    return "\nUNION ALL ".join(parts)


@query("null_counts", oracle(_per_column_sql(lambda c: f"count(*) FILTER (WHERE {c} IS NULL) AS nulls"), text=True))
def q_null_counts(spark, sf):
    return stats.null_counts(R(spark, sf, True)).withColumnRenamed("column", "column_name")


_SPARK_TYPES = {"asin": "string", "overall": "double", "verified": "boolean", "reviewText": "string",
                "reviewerID": "string", "summary": "string", "unixReviewTime": "int", "vote": "string"}


@query("table_info", oracle(_per_column_sql(lambda c: f"count({c}) AS non_null",
                                            lambda i, c: f"'{_SPARK_TYPES[c]}' AS dtype, "), text=True))
def q_table_info(spark, sf):
    return stats.table_info(R(spark, sf, True)).withColumnRenamed("column", "column_name")


@query("drop_incomplete", oracle(f"""
SELECT {_TEXT_OUT} FROM reviews WHERE {' AND '.join(f'{c} IS NOT NULL' for c in REVIEW_COLUMNS)}""", text=True))
def q_drop_incomplete(spark, sf):
    return _text_out(prep.drop_incomplete(R(spark, sf, True)))


@query("incomplete_rows", oracle(f"""
SELECT {_TEXT_OUT} FROM reviews WHERE {' OR '.join(f'{c} IS NULL' for c in REVIEW_COLUMNS if c != 'verified')}""",
                                 text=True))
def q_incomplete_rows(spark, sf):
    cols = [c for c in REVIEW_COLUMNS if c != "verified"]
    return _text_out(prep.incomplete_rows(R(spark, sf, True), cols))


@query("only_verified", oracle(f"SELECT {_TEXT_OUT} FROM reviews WHERE verified", text=True))
def q_only_verified(spark, sf):
    return _text_out(prep.only_verified(R(spark, sf, True)))


@query("since_filter", oracle(f"SELECT {_TEXT_OUT} FROM reviews WHERE unixReviewTime >= {FIXTURE_SINCE}", text=True))
def q_since(spark, sf):
    return _text_out(prep.since(R(spark, sf, True), FIXTURE_SINCE))


@query("min_text_length", oracle("""
SELECT asin, reviewerID, unixReviewTime, CAST(length(reviewText) AS INTEGER) AS text_len FROM reviews
WHERE length(reviewText) >= 5""", text=True))
def q_min_text_length(spark, sf):
    return (prep.min_text_length(R(spark, sf, True), 5)
            .select("asin", "reviewerID", "unixReviewTime", F.length("reviewText").alias("text_len")))


def _with_copies(spark, sf, change=None):
    """The reviews and, a second time, those of a quarter of the products (changed, if told to):
    the given tables hold next to no duplicates."""
    df = R(spark, sf, True)
    again = df.where(F.substring(F.md5("asin"), 1, 1) < "4")
    return df.unionByName(change(again) if change else again)


_COPIES = "SELECT * FROM reviews UNION ALL SELECT {} FROM reviews WHERE substr(md5(asin), 1, 1) < '4'"


@query("dedup_exact", oracle(f"SELECT {_TEXT_OUT} FROM (SELECT DISTINCT * FROM ({_COPIES.format('*')}))", text=True))
def q_dedup_exact(spark, sf):
    return _text_out(dedup.drop_exact_duplicates(_with_copies(spark, sf)))


@query("dedup_reviews", oracle(f"""
SELECT {_TEXT_OUT} FROM (
  SELECT *, row_number() OVER (PARTITION BY asin, reviewerID, unixReviewTime
      ORDER BY overall NULLS FIRST, verified NULLS FIRST, reviewText NULLS FIRST, summary NULLS FIRST, vote NULLS FIRST) AS rn
  FROM ({_COPIES.format('asin, overall - 1 AS overall, verified, reviewText, reviewerID, summary, unixReviewTime, vote')}))
WHERE rn = 1""", text=True))
def q_dedup_reviews(spark, sf):
    lower = lambda df: df.withColumn("overall", F.col("overall") - 1)
    return _text_out(dedup.drop_duplicate_reviews(_with_copies(spark, sf, lower)))


@query("distinct_users", oracle("SELECT DISTINCT reviewerID FROM reviews"))
def q_distinct_users(spark, sf):
    return dedup.distinct_keys(R(spark, sf), "reviewerID")


@query("distinct_items", oracle("SELECT DISTINCT asin FROM reviews"))
def q_distinct_items(spark, sf):
    return dedup.distinct_keys(R(spark, sf), "asin")


@query("merge_summary", oracle("""
SELECT asin, reviewerID, unixReviewTime, md5(concat_ws(' ', reviewText, summary)) AS text_md5,
       CAST(length(concat_ws(' ', reviewText, summary)) AS INTEGER) AS text_len FROM reviews""", text=True))
def q_merge_summary(spark, sf):
    df = prep.merge_summary(R(spark, sf, True))
    return df.select("asin", "reviewerID", "unixReviewTime", F.md5("reviewText").alias("text_md5"),
                     F.length("reviewText").alias("text_len"))


@query("feedback_counts", oracle("""
SELECT count(*) FILTER (WHERE overall >= 3) AS good, count(*) FILTER (WHERE NOT (overall >= 3) OR overall IS NULL) AS bad
FROM reviews"""))
def q_feedback_counts(spark, sf):
    return stats.feedback_counts(prep.label_feedback(R(spark, sf)))


VOTE_SQL = "try_cast(replace(vote, ',', '') AS DOUBLE)"


@query("parse_vote", oracle(f"""
SELECT vote, {VOTE_SQL} AS vote_num, count(*) AS n FROM reviews GROUP BY 1, 2"""))
def q_parse_vote(spark, sf):
    df = R(spark, sf).select("vote", prep.vote_number("vote").alias("vote_num"))
    return df.groupBy("vote", "vote_num").agg(F.count(F.lit(1)).alias("n"))


@query("fill_vote_global", oracle(f"""
WITH m AS (SELECT round(avg({VOTE_SQL}), 2) AS mv FROM reviews)
SELECT asin, reviewerID, unixReviewTime, coalesce({VOTE_SQL}, m.mv) AS vote FROM reviews, m"""))
def q_fill_vote_global(spark, sf):
    return prep.fill_vote_global(R(spark, sf)).select("asin", "reviewerID", "unixReviewTime", "vote")


@query("fill_vote_by_product", oracle(f"""
WITH p AS (SELECT *, {VOTE_SQL} AS v FROM reviews),
k AS (SELECT asin, avg(v) AS km FROM p GROUP BY asin),
g AS (SELECT avg(v) AS gm FROM p)
SELECT p.asin, p.reviewerID, p.unixReviewTime, cast(trunc(coalesce(p.v, k.km, g.gm)) AS INTEGER) AS vote
FROM p JOIN k ON p.asin = k.asin, g"""))
def q_fill_vote_by_product(spark, sf):
    return prep.fill_vote_by_product(R(spark, sf)).select("asin", "reviewerID", "unixReviewTime", "vote")


@query("minmax_scale", oracle("""
WITH s AS (SELECT min(overall) AS lo, max(overall) AS hi FROM reviews)
SELECT asin, reviewerID, unixReviewTime, CASE WHEN hi = lo THEN NULL ELSE (overall - lo) / (hi - lo) END AS y
FROM reviews, s"""))
def q_minmax_scale(spark, sf):
    return prep.minmax_scale(R(spark, sf)).select("asin", "reviewerID", "unixReviewTime", "y")


_NUMERIC = ["overall", "unixReviewTime", "vote"]


def _numeric_view(spark, sf):
    return R(spark, sf).select("overall", "verified", "unixReviewTime", prep.vote_number("vote").alias("vote"))


@query("numeric_columns", oracle(f"""
WITH r AS (SELECT overall, unixReviewTime, {VOTE_SQL} AS vote FROM reviews),
c AS ({' UNION ALL '.join(f"SELECT {i + 1} AS position, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS nulls, count(DISTINCT {c}) > 1 AS varies FROM r" for i, c in enumerate(_NUMERIC))})
SELECT *, (nulls = 0 AND varies) AND
       sum(CASE WHEN nulls = 0 AND varies THEN 1 ELSE 0 END) OVER (ORDER BY position) <= 10 AS keep
FROM c"""))
def q_numeric_columns(spark, sf):
    return prep.numeric_columns(_numeric_view(spark, sf)).withColumnRenamed("column", "column_name")


@query("reviews_per_product", oracle("SELECT asin, count(reviewerID) AS n_reviews FROM reviews GROUP BY asin"))
def q_reviews_per_product(spark, sf):
    return stats.reviews_per_product(R(spark, sf))


@query("reviews_per_product_rating", oracle("""
SELECT asin, overall, count(reviewerID) AS n_reviews FROM reviews GROUP BY asin, overall"""))
def q_reviews_per_product_rating(spark, sf):
    return stats.reviews_per_product_rating(R(spark, sf))


@query("distinct_counts", oracle("""
SELECT count(DISTINCT reviewerID) AS n_reviewers, count(DISTINCT asin) AS n_products FROM reviews"""))
def q_distinct_counts(spark, sf):
    return stats.distinct_counts(R(spark, sf))


_DESCRIBE = ["overall", "unixReviewTime", "vote"]


@query("describe_numeric", oracle(f"""
WITH r AS (SELECT overall, unixReviewTime, {VOTE_SQL} AS vote FROM reviews)
""" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 4) AS mean, "
    f"round(stddev_samp({c}), 4) AS std, min({c}) AS min, round(quantile_cont({c}, 0.25), 4) AS p25, "
    f"round(quantile_cont({c}, 0.5), 4) AS p50, round(quantile_cont({c}, 0.75), 4) AS p75, "
    f"max({c}) AS max FROM r" for c in _DESCRIBE)))
def q_describe_numeric(spark, sf):
    df = R(spark, sf).select(*_DESCRIBE).withColumn("vote", prep.vote_number("vote"))
    out = stats.describe_numeric(df, _DESCRIBE)
    return out.select(F.col("column").alias("column_name"), "count",
                      *[F.round(c, 4).alias(c) for c in ("mean", "std")], "min",
                      *[F.round(c, 4).alias(c) for c in ("p25", "p50", "p75")], "max")


@query("mean_rating", oracle("SELECT round(avg(overall), 2) AS mean_rating FROM reviews"))
def q_mean_rating(spark, sf):
    return stats.mean_rating(R(spark, sf))


@query("rating_range", oracle("SELECT min(overall) AS min_rating, max(overall) AS max_rating FROM reviews"))
def q_rating_range(spark, sf):
    return stats.rating_range(R(spark, sf))


@query("mean_vote", oracle(f"SELECT round(avg({VOTE_SQL}), 2) AS mean_vote FROM reviews"))
def q_mean_vote(spark, sf):
    return stats.mean_vote(R(spark, sf))


@query("top_products", oracle("""
SELECT asin, count(*) AS n FROM reviews GROUP BY asin ORDER BY n DESC, asin LIMIT 10"""))
def q_top_products(spark, sf):
    return stats.value_counts_top(R(spark, sf), "asin", 10)


@query("verified_counts", oracle("SELECT verified, count(*) AS n FROM reviews GROUP BY verified"))
def q_verified_counts(spark, sf):
    return stats.category_counts(R(spark, sf), "verified")


def histogram_sql(value_sql: str, bins: int, source: str = "reviews") -> str:
    return f"""
WITH v AS (SELECT {value_sql} AS x FROM {source}),
v2 AS (SELECT x FROM v WHERE x IS NOT NULL),
s AS (SELECT min(x) AS lo, max(x) AS hi FROM v2),
c AS (SELECT CASE WHEN s.hi = s.lo THEN 1
             ELSE least(floor(CAST({bins} AS DOUBLE) * (x - s.lo) / (s.hi - s.lo)) + 1, {bins}) END AS bin,
             count(*) AS n FROM v2, s GROUP BY 1),
b AS (SELECT CAST(range AS INTEGER) AS bin FROM range(1, {bins + 1}))
SELECT b.bin, round(s.lo + (b.bin - 1) * (s.hi - s.lo) / {bins}, 6) AS lower,
       round(s.lo + b.bin * (s.hi - s.lo) / {bins}, 6) AS upper, coalesce(c.n, 0) AS n
FROM b CROSS JOIN s LEFT JOIN c ON b.bin = c.bin"""


@query("rating_histogram", oracle(histogram_sql("overall", 10)))
def q_rating_histogram(spark, sf):
    return stats.histogram(R(spark, sf), "overall", 10)


@query("vote_histogram", oracle(histogram_sql(VOTE_SQL, 20)))
def q_vote_histogram(spark, sf):
    return stats.histogram(R(spark, sf), prep.vote_number("vote"), 20)


def kde_sql(value_sql: str, grid: int, cut: float = 3.0, source: str = "reviews") -> str:
    return f"""
WITH v AS (SELECT x FROM (SELECT {value_sql} AS x FROM {source}) WHERE x IS NOT NULL),
s AS (SELECT count(*) AS n, stddev_samp(x) AS sd, min(x) AS lo, max(x) AS hi FROM v),
p AS (SELECT n, lo, hi, sd * pow(n, -0.2) AS h FROM s),
q AS (SELECT n, h, lo - CAST({cut} AS DOUBLE) * h AS start,
             (hi - lo + CAST({2 * cut} AS DOUBLE) * h) / CAST({grid - 1} AS DOUBLE) AS step FROM p),
d AS (SELECT x, count(*) AS c FROM v GROUP BY x),
g AS (SELECT CAST(range AS INTEGER) AS point FROM range(0, {grid}))
SELECT g.point, round(q.start + g.point * q.step, 6) AS x,
       round(sum(d.c * exp(-0.5 * pow(((q.start + g.point * q.step) - d.x) / q.h, 2))) / (q.n * q.h * sqrt(2 * pi())), 6) AS density
FROM g CROSS JOIN q CROSS JOIN d GROUP BY g.point, q.start, q.step, q.n, q.h"""


@query("rating_kde", oracle(kde_sql("overall", 200)))
def q_rating_kde(spark, sf):
    return stats.kde(R(spark, sf), "overall", 200)


_CORR = ["overall", "verified", "unixReviewTime", "vote"]


@query("correlation_matrix", oracle(f"""
WITH r AS (SELECT overall, CAST(verified AS DOUBLE) AS verified, CAST(unixReviewTime AS DOUBLE) AS unixReviewTime,
                  {VOTE_SQL} AS vote FROM reviews)
""" + "\nUNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM r"
    for i, a in enumerate(_CORR) for b in _CORR[i + 1:])))
def q_correlation_matrix(spark, sf):
    return stats.correlation_matrix(_numeric_view(spark, sf), _CORR)


# the columns that numeric_columns keeps
_SCATTER = ["overall", "unixReviewTime"]


def _bin_sql(c, bins=10):
    return (f"CASE WHEN (SELECT max({c}) FROM r) = (SELECT min({c}) FROM r) THEN 1 ELSE CAST(least(floor("
            f"CAST({bins} AS DOUBLE) * ({c} - (SELECT min({c}) FROM r)) / ((SELECT max({c}) FROM r) - "
            f"(SELECT min({c}) FROM r))) + 1, {bins}) AS INTEGER) END")


@query("scatter_bins", oracle("""
WITH r AS (SELECT overall, CAST(unixReviewTime AS DOUBLE) AS unixReviewTime FROM reviews)
""" + "\nUNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, {_bin_sql(a)} AS bin_a, {_bin_sql(b)} AS bin_b, count(*) AS n, "
    f"(SELECT round(corr({a}, {b}), 6) FROM r) AS corr "
    f"FROM r GROUP BY 1, 2, 3, 4" for i, a in enumerate(_SCATTER) for b in _SCATTER[i + 1:])))
def q_scatter_bins(spark, sf):
    return stats.scatter_matrix(_numeric_view(spark, sf))["cells"]


@query("scatter_diagonal", oracle("\nUNION ALL ".join(
    f"SELECT '{c}' AS column_name, point, round(x, 2) AS x, density FROM ({kde_sql(f'CAST({c} AS DOUBLE)', 50)})" for c in _SCATTER)))
def q_scatter_diagonal(spark, sf):
    out = stats.scatter_matrix(_numeric_view(spark, sf))["diagonal"]
    return out.withColumnRenamed("column", "column_name").withColumn("x", F.round("x", 2))


@query("constant_kde", oracle("SELECT point, CAST(3 AS DOUBLE) AS x, CAST(NULL AS DOUBLE) AS density "
                              "FROM (SELECT CAST(range AS INTEGER) AS point FROM range(0, 20)) WHERE EXISTS (SELECT 1 FROM reviews)"))
def q_constant_kde(spark, sf):
    return stats.kde(R(spark, sf).withColumn("three", F.lit(3.0)), "three", 20)


@query("best_rated", oracle("""
SELECT asin, reviewerID, overall, unixReviewTime FROM reviews
ORDER BY overall DESC, asin, reviewerID, unixReviewTime LIMIT 10"""))
def q_best_rated(spark, sf):
    return stats.best_rated(R(spark, sf), 10)


@query("worst_rated", oracle("""
SELECT asin, reviewerID, overall, unixReviewTime FROM reviews
ORDER BY overall ASC, asin, reviewerID, unixReviewTime LIMIT 10"""))
def q_worst_rated(spark, sf):
    return stats.worst_rated(R(spark, sf), 10)


def _by_product_sql(way):
    return f"""
SELECT asin, round(avg(overall), 6) AS mean_rating, count(overall) AS n_reviews FROM reviews GROUP BY asin
HAVING count(overall) >= 20 ORDER BY avg(overall) {way}, n_reviews DESC, asin LIMIT 10"""


@query("best_products", oracle(_by_product_sql("DESC")))
def q_best_products(spark, sf):
    out = stats.best_rated(R(spark, sf), 10, by_product=True, min_reviews=20)
    return out.withColumn("mean_rating", F.round("mean_rating", 6))


@query("worst_products", oracle(_by_product_sql("ASC")))
def q_worst_products(spark, sf):
    out = stats.worst_rated(R(spark, sf), 10, by_product=True, min_reviews=20)
    return out.withColumn("mean_rating", F.round("mean_rating", 6))


@query("user_history", oracle("""
WITH pick AS (SELECT reviewerID FROM (SELECT DISTINCT reviewerID FROM reviews)
              ORDER BY md5(concat('42|', reviewerID)), reviewerID LIMIT 1)
SELECT asin, reviewerID, overall, unixReviewTime FROM reviews WHERE reviewerID IN (SELECT reviewerID FROM pick)"""))
def q_user_history(spark, sf):
    from ..operators import recommend as rc
    ratings = R(spark, sf).select("asin", "reviewerID", "overall", "unixReviewTime")
    pick = rc.sample_user(ratings).select("reviewerID")
    # P15 for a user chosen by M8; the pick is one row (broadcast)
    return ratings.join(F.broadcast(pick), "reviewerID", "left_semi")
