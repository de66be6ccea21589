"""Registered queries of the serving side and of the file-order, density and look-up operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import dedup, density, prep, stats, terms
from ..operators import recommend as rc
from ..session import scratch_path
from ..sources import reviews as io
from ..sources.fixtures import table
from ..streaming import messages as ms
from . import job_queries, jobs, profile_queries, text_queries  # noqa: F401  the profile job's SQL is theirs
from .language_queries import _COUNTS, _vocabulary
from .profile_queries import R
from .recommend_queries import _ratings, _requested, _split
from .registry import ORACLES, oracle, query
from .stream_queries import BIAS_TOP10_SQL, _decoded_rows

VOTE_SQL = "try_cast(replace(vote, ',', '') AS DOUBLE)"
KEY = ["unixReviewTime", "reviewerID", "asin"]


@query("vote_in_file_order", oracle(f"""
WITH v AS (SELECT asin, reviewerID, unixReviewTime, min(CASE WHEN substr(md5(asin), 1, 1) < '8' THEN NULL ELSE {VOTE_SQL} END) AS v
           FROM reviews GROUP BY asin, reviewerID, unixReviewTime),
k AS (SELECT asin, avg(v) AS km FROM v GROUP BY asin),
f AS (SELECT v.asin, reviewerID, unixReviewTime, coalesce(v.v, k.km) AS x FROM v JOIN k ON v.asin = k.asin),
b AS (SELECT *, first_value(x IGNORE NULLS) OVER (ORDER BY unixReviewTime, reviewerID, asin ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nx FROM f),
g AS (SELECT avg(v) AS gm FROM v)
SELECT asin, reviewerID, unixReviewTime, CAST(trunc(coalesce(nx, gm)) AS INTEGER) AS vote FROM b, g"""))
def q_vote_in_file_order(spark, sf):
    """P13 with the products of half the codes without a vote: they take the next vote in order."""
    rows = R(spark, sf).select("asin", "reviewerID", "unixReviewTime", prep.vote_number("vote").alias("vote"))
    rows = rows.withColumn("vote", F.when(F.substring(F.md5("asin"), 1, 1) >= "8", F.col("vote")))
    one = rows.groupBy("asin", "reviewerID", "unixReviewTime").agg(F.min("vote").cast("string").alias("vote"))
    return prep.fill_vote_by_product(one, order=KEY).select("asin", "reviewerID", "unixReviewTime", "vote")


@query("price_density", oracle("""
WITH v AS (SELECT CAST(o_totalprice AS DOUBLE) / 1000 AS x FROM orders WHERE o_totalprice IS NOT NULL),
s AS (SELECT count(*) AS n, stddev_samp(x) * pow(count(*), -0.2) AS h, min(x) AS lo, max(x) AS hi, (max(x) - min(x)) / CAST(4096 AS DOUBLE) AS w FROM v),
q AS (SELECT *, lo - 3 * h AS start, (hi - lo + 6 * h) / CAST(199 AS DOUBLE) AS step FROM s),
c AS (SELECT least(floor((x - lo) / w), 4095) AS cell, (x - lo) / w - least(floor((x - lo) / w), 4095) AS f FROM v, q),
m AS (SELECT cell, sum(wt) AS wt FROM (SELECT cell, 1 - f AS wt FROM c UNION ALL SELECT cell + 1, f FROM c) GROUP BY cell),
g AS (SELECT CAST(range AS INTEGER) AS point FROM range(0, 200))
SELECT point, round(start + point * step, 6) AS x,
       round(sum(CASE WHEN abs(start + point * step - (lo + cell * w)) <= 8 * h + step THEN
             wt * exp(-0.5 * pow((start + point * step - (lo + cell * w)) / h, 2)) ELSE 0 END) / (n * h * sqrt(2 * pi())), 9) AS density
FROM g, q, m GROUP BY point, start, step, n, h"""))
def q_price_density(spark, sf):
    """A18 on a continuous column: binned, so that rows do not grow with the distinct values."""
    orders = table(spark, sf, "orders").select((F.col("o_totalprice").cast("double") / 1000).alias("x"))
    return stats.kde_binned(orders, "x").withColumn("density", F.round("density", 9))


@query("described_columns", oracle(f"""
WITH r AS (SELECT overall, CAST(unixReviewTime AS DOUBLE) AS unixReviewTime, {VOTE_SQL} AS votes FROM reviews)
""" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS name, count({c}) AS n, min({c}) AS low, round(quantile_cont({c}, 0.5), 4) AS median, max({c}) AS high FROM r"
    for c in ("overall", "unixReviewTime", "votes"))))
def q_described_columns(spark, sf):
    """A11 on whole rows: text and booleans are left out by type."""
    df = R(spark, sf).withColumn("votes", prep.vote_number("vote"))
    return stats.describe_numeric(df).select(F.col("column").alias("name"), F.col("count").alias("n"), F.col("min").alias("low"),
                                             F.round("p50", 4).alias("median"), F.col("max").alias("high"))


@query("accent_folded_counts", oracle(f"""
SELECT strip_accents(term) AS term, CAST(sum(n) AS BIGINT) AS n FROM ({_COUNTS}) GROUP BY 1"""))
def q_accent_folded_counts(spark, sf):
    """A user's normaliser on the vocabulary."""
    def make():
        import unicodedata

        def fold(word: str) -> str:
            return "".join(c for c in unicodedata.normalize("NFD", word) if not unicodedata.combining(c))
        return fold

    counts = _vocabulary(spark, sf)
    return terms.map_vocabulary(counts, terms.normaliser_mapping(counts, make))


@query("recommendation_runs", oracle("SELECT run, reviewerID, rank, asin, score FROM (" + BIAS_TOP10_SQL.strip().replace(
    "SELECT u AS reviewerID, CAST(rank", "SELECT run, u AS reviewerID, CAST(rank").replace(
    "FROM ranked, g WHERE rank <= 10", "FROM ranked, g, (VALUES ('monday'), ('tuesday')) runs(run) WHERE rank <= 10") + ")"))
def q_recommendation_runs(spark, sf):
    """Two runs are kept side by side, and a run that is repeated replaces its own rows."""
    store = scratch_path(spark, "recommendations")
    recs = rc.recommend_bias(_ratings(spark, sf), 10)
    recs.write.parquet(path := scratch_path(spark, "recs"))
    recs = spark.read.parquet(path)
    for run in ("monday", "tuesday", "monday"):
        io.append_rows(recs, store, run)
    return spark.read.parquet(store).select(F.col("run_id").alias("run"), "reviewerID", "rank", "asin", "score")


@query("consume_after_restart", oracle(BIAS_TOP10_SQL.replace(
    "FROM ranked, g WHERE rank <= 10", "FROM ranked, g WHERE rank <= 10 AND substr(md5(u), 1, 1) >= '8'")))
def q_consume_after_restart(spark, sf):
    """A consumer of the latest messages starts after the first half was published, goes down, and
    is started again after the second half: it has the second half, and no message twice."""
    log, sink, checkpoint = (scratch_path(spark, x) for x in ("log", "consumed", "ckpt"))
    rc.recommend_bias(_ratings(spark, sf), 10).write.parquet(path := scratch_path(spark, "recs"))
    messages = ms.encode_messages(spark.read.parquet(path))
    late = F.substring(F.md5("key"), 1, 1) >= "8"

    def run():
        jobs.consume_job(spark, log, sink, checkpoint, fmt="log").awaitTermination()
    ms.publish(messages.where(~late), log, fmt="log")
    run()
    ms.publish(messages.where(late), log, fmt="log")
    run()
    run()
    return _decoded_rows(spark.read.parquet(f"{sink}/rows"))


@query("consume_null_entries", oracle("""
SELECT DISTINCT reviewerID AS key, 'null entries' AS reason FROM reviews WHERE substr(md5(reviewerID), 1, 1) = '0'"""))
def q_consume_null_entries(spark, sf):
    """R2: an entry that is lost for being null is in the rejects."""
    messages = ms.encode_messages(rc.recommend_bias(_ratings(spark, sf), 10))
    holed = messages.withColumn("value", F.when(F.substring(F.md5("key"), 1, 1) == "0", F.regexp_replace("value", r'^\{"asin":\["[^"]*"', '{"asin":[null'))
                                .otherwise(F.col("value")))
    return ms.rejected_messages(ms.decode_messages(holed)).select("key", "reason")


@query("bucketed_active_users", oracle("""
SELECT r.reviewerID, r.asin, r.overall FROM reviews r JOIN (SELECT reviewerID FROM reviews GROUP BY reviewerID HAVING count(*) >= 3) u
ON r.reviewerID = u.reviewerID"""))
def q_bucketed_active_users(spark, sf):
    """S7 + J2: the users' counts and the join back on a bucketed table, without an exchange."""
    name = "ratewise_reviews_by_user"
    io.write_bucketed(R(spark, sf).select("reviewerID", "asin", "overall"), name, "reviewerID", 8, ["reviewerID"], scratch_path(spark, "bucketed"))
    return density.keep_active_users(spark.table(name), 3).select("reviewerID", "asin", "overall")


@query("logistic_mf_top10")
def q_logistic_mf_top10(spark, sf):
    """M6 with the trained model of M3b for the users that ask."""
    from ..operators import mf
    split, users, items = _split(spark, sf)
    u, i, _ = mf.fit_logistic_mf(split.where(F.col("split") == "train"))
    recs = rc.recommend(_requested(spark, sf, users), u, i, split, 10, logistic=True)
    named = rc.decode_ids(rc.decode_ids(recs, users, "reviewerID", "user"), items, "asin", "item")
    return named.select("reviewerID", "rank", "asin", F.round("score", 6).alias("score"))


@query("new_users", oracle("""
SELECT DISTINCT reviewerID FROM reviews WHERE substr(md5(asin), 1, 1) = '0'
EXCEPT SELECT reviewerID FROM reviews WHERE substr(md5(asin), 1, 1) <> '0'"""))
def q_new_users(spark, sf):
    """The users of some products that are not among the users of the others."""
    df = R(spark, sf).select("reviewerID", (F.substring(F.md5("asin"), 1, 1) == "0").alias("own"))
    return dedup.set_difference(dedup.distinct_keys(df.where("own"), "reviewerID"), df.where("NOT own"), ["reviewerID"])


@query("sample_user_history", oracle("""
WITH pick AS (SELECT reviewerID FROM (SELECT DISTINCT reviewerID FROM reviews) ORDER BY md5(concat('42|', reviewerID)), reviewerID LIMIT 1)
SELECT reviewerID, asin, CAST(overall AS FLOAT) AS overall, unixReviewTime FROM reviews WHERE reviewerID = (SELECT reviewerID FROM pick)"""))
def q_sample_user_history(spark, sf):
    """One user's rows, the rating as float32."""
    ratings = _ratings(spark, sf)
    user = rc.sample_user(ratings).first()["reviewerID"]
    return prep.to_float32(prep.history_of(ratings, user)).select("reviewerID", "asin", "overall", "unixReviewTime")


@query("quarantined_rows", oracle("""
SELECT asin, reviewerID, unixReviewTime FROM reviews WHERE substr(md5(reviewerID), 1, 1) = '0'""", text=True))
def q_quarantined_rows(spark, sf):
    """The lines that are set aside, by the fields that stand in them."""
    _, bad = io.read_reviews(spark, job_queries._dump(spark, sf, job_queries.FASTEST), quarantine=True)
    return bad.select(F.regexp_extract("line", r'^\{"asin":"(B[0-9]+)"', 1).alias("asin"), F.regexp_extract("line", '"reviewerID":"(U[0-9]+)"', 1).alias("reviewerID"),
                      F.regexp_extract("line", '"unixReviewTime":(-?[0-9]+)[^"]*("vote":"[^"]*")?[^"]*$', 1).cast("int").alias("unixReviewTime"))


@query("loaded_rows", oracle(f"""
SELECT DISTINCT asin, overall, verified, reviewerID, summary, unixReviewTime, vote, md5(reviewText) AS text_md5 FROM reviews
WHERE {job_queries._FULL}""", text=True))
def q_loaded_rows(spark, sf):
    """the rows that the load job stores."""
    out = scratch_path(spark, "loaded")
    jobs.load_job(spark, job_queries._dump(spark, sf), out)
    return spark.read.parquet(out).select("asin", "overall", "verified", "reviewerID", "summary", "unixReviewTime", "vote",
                                          F.md5("reviewText").alias("text_md5"))


#: Tables of the profile job with the query that states each, its columns, and which of them are doubles.
PROFILE = {
    "top_products": ("top_products", "asin n", ""),
    "verified_counts": ("verified_counts", "verified n", ""),
    "rating_histogram": ("rating_histogram", "bin lower upper n", "lower upper"),
    "vote_histogram": ("vote_histogram", "bin lower upper n", "lower upper"),
    "review_length_histogram": ("review_length_histogram", "bin lower upper n", "lower upper"),
    "mean_rating": ("mean_rating", "mean_rating", "mean_rating"),
    "best_rated": ("best_rated", "asin reviewerID overall unixReviewTime", "overall"),
    "worst_rated": ("worst_rated", "asin reviewerID overall unixReviewTime", "overall"),
    "top_terms_by_rating": ("top_terms_by_rating", "overall term n rank", "overall"),
    "term_cloud": ("term_cloud_weights", "word n rank weight", "weight"),
    "top_terms": ("top_terms", "term n rank", ""),
    "top_bigrams": ("top_bigrams", "bigram n rank", ""),
}


def _line_sql(table_: str) -> str:
    of, columns, doubles = PROFILE[table_]
    parts = [f"CAST(CAST({c} AS DECIMAL(20, 6)) AS VARCHAR)" if c in doubles.split() else f"CAST({c} AS VARCHAR)" for c in columns.split()]
    return f"SELECT '{table_}' AS tbl, concat_ws('|', {', '.join(parts)}) AS line FROM ({ORACLES[of]})"


@query("eda_job", "\nUNION ALL ".join(map(_line_sql, PROFILE)))
def q_eda_job(spark, sf):
    """the tables of the profile job as lines."""
    made, out = jobs.eda_tables(R(spark, sf, True)), None
    for name, (_, columns, doubles) in PROFILE.items():
        parts = [F.col(c).cast("decimal(20,6)").cast("string") if c in doubles.split() else F.col(c).cast("string") for c in columns.split()]
        lines = made[name].select(F.lit(name).alias("tbl"), F.concat_ws("|", *parts).alias("line"))
        out = lines if out is None else out.unionByName(lines)
    return out
