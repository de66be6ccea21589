"""Registered streaming / messaging queries. Streams run with ``availableNow`` over file
sources and sinks in the shared checkpoint folder, then the sink is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import density
from ..operators import recommend as rc
from ..session import scratch_path
from ..streaming import messages as ms
from .profile_queries import FIXTURE_SINCE, R
from .recommend_queries import BIAS_CTES, _ratings
from .registry import oracle, query

BIAS_TOP10_SQL = BIAS_CTES + """,
seen AS (SELECT DISTINCT u, i FROM r),
cand AS (SELECT ub.u, ib.i, ib.bi, ub.bu FROM ub CROSS JOIN ib
         WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.u = ub.u AND s.i = ib.i)),
ranked AS (SELECT u, i, bi, bu, row_number() OVER (PARTITION BY u ORDER BY bi DESC, i) AS rank FROM cand)
SELECT u AS reviewerID, CAST(rank AS INTEGER) AS rank, i AS asin, round(g.mu + bi + bu, 6) AS score
FROM ranked, g WHERE rank <= 10"""


def _decoded_rows(df):
    return df.select(F.col("key").alias("reviewerID"), "rank", "asin", F.col("overall").alias("score"))


@query("message_roundtrip", oracle(BIAS_TOP10_SQL))
def q_message_roundtrip(spark, sf):
    recs = rc.recommend_bias(_ratings(spark, sf), 10)
    decoded = ms.decode_messages(ms.encode_messages(recs))
    return _decoded_rows(ms.explode_recommendations(decoded, 10))


@query("recommendation_stream", oracle(BIAS_TOP10_SQL))
def q_recommendation_stream(spark, sf):
    topic = scratch_path(spark, "topic")
    sink = scratch_path(spark, "recs-sink")
    recs = rc.recommend_bias(_ratings(spark, sf), 10)
    ms.publish(ms.encode_messages(recs), topic, fmt="json")
    stream = ms.consume(spark, topic, fmt="json", starting_offsets="earliest")
    rows = ms.explode_recommendations(ms.decode_messages(stream), 10)
    q = ms.sink_batches(rows, sink, scratch_path(spark, "recs-ckpt"))
    q.awaitTermination()
    return _decoded_rows(spark.read.parquet(sink).drop("query_id", "batch_id"))


_BROKEN_SQL = """
SELECT reviewerID AS key, 'malformed' AS reason FROM (SELECT DISTINCT reviewerID FROM reviews) WHERE substr(md5(reviewerID), 1, 1) = '0'
UNION ALL
SELECT reviewerID AS key, 'lists of unequal length' AS reason FROM (SELECT DISTINCT reviewerID FROM reviews) WHERE substr(md5(reviewerID), 1, 1) = '1'"""


def _published(spark, sf):
    """A topic of every user's messages, some of them cut off or with a score too few."""
    topic = scratch_path(spark, "topic")
    recs = rc.recommend_bias(_ratings(spark, sf), 10)
    h = F.substring(F.md5("key"), 1, 1)
    messages = ms.encode_messages(recs).withColumn(
        "value", F.when(h == "0", F.expr("substring(value, 1, length(value) - 1)"))
        .when(h == "1", F.regexp_replace("value", r",[^,\]]*\]\}$", "]}")).otherwise(F.col("value")))
    ms.publish(messages, topic, fmt="json")
    return topic


@query("consume_rejects", oracle(_BROKEN_SQL))
def q_consume_rejects(spark, sf):
    from . import jobs
    sink = scratch_path(spark, "consumed")
    jobs.consume_job(spark, _published(spark, sf), sink, scratch_path(spark, "ckpt"), starting_offsets="earliest").awaitTermination()
    return spark.read.parquet(f"{sink}/rejects").select("key", "reason")


@query("consume_replay", oracle(BIAS_TOP10_SQL.replace("FROM ranked, g WHERE rank <= 10", """FROM ranked, g
WHERE rank <= 10 AND substr(md5(u), 1, 1) <> '0' AND NOT (rank = 10 AND substr(md5(u), 1, 1) = '1')""")))
def q_consume_replay(spark, sf):
    """A second consumer with a checkpoint of its own replays the topic into the same sink: each
    run's rows are whole, none is overwritten."""
    from . import jobs
    sink, topic = scratch_path(spark, "consumed"), _published(spark, sf)
    for _ in range(2):
        jobs.consume_job(spark, topic, sink, scratch_path(spark, "ckpt"), starting_offsets="earliest").awaitTermination()
    rows = spark.read.parquet(f"{sink}/rows")
    twice = rows.groupBy("key", "rank", "asin", "overall").agg(F.count_distinct("query_id").alias("n")).where("n = 2")
    return _decoded_rows(twice)


def _filtered_ratings(spark, sf):
    return density.density_filter(R(spark, sf, True), since_ts=FIXTURE_SINCE).select("reviewerID", "asin", "overall")


SERVE_SQL = f"""
WITH recent AS (SELECT * FROM reviews WHERE unixReviewTime >= {FIXTURE_SINCE} AND length(reviewText) >= 5),
items0 AS (SELECT asin FROM recent GROUP BY asin HAVING count(overall) >= 3),
j1 AS (SELECT * FROM recent WHERE asin IN (SELECT asin FROM items0)),
users0 AS (SELECT reviewerID FROM j1 GROUP BY reviewerID HAVING count(*) >= 3),
f AS (SELECT reviewerID, asin, overall FROM j1 WHERE reviewerID IN (SELECT reviewerID FROM users0)),
r AS (SELECT reviewerID AS u, asin AS i, overall AS y FROM f WHERE overall IS NOT NULL),
g AS (SELECT sum(y) / count(y) AS mu FROM r),
ib AS (SELECT r.i, count(r.y) AS n, (sum(r.y) - count(r.y) * g.mu) / (count(r.y) + CAST(10 AS DOUBLE)) AS bi
       FROM r, g GROUP BY r.i, g.mu),
ub AS (SELECT r.u, sum(r.y - g.mu - ib.bi) / (count(*) + CAST(10 AS DOUBLE)) AS bu FROM r JOIN ib ON r.i = ib.i, g GROUP BY r.u),
seen AS (SELECT DISTINCT u, i FROM r),
cand AS (SELECT ub.u, ib.i, ib.bi, ub.bu FROM ub CROSS JOIN ib
         WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.u = ub.u AND s.i = ib.i)),
ranked AS (SELECT u, i, bi, bu, row_number() OVER (PARTITION BY u ORDER BY bi DESC, i) AS rank FROM cand),
recs AS (SELECT u AS reviewerID, CAST(rank AS INTEGER) AS rank, i AS asin, round(g.mu + bi + bu, 6) AS score
         FROM ranked, g WHERE rank <= 10),
fb AS (SELECT CAST(row_number() OVER (ORDER BY bi DESC, i) AS INTEGER) AS rank, i AS asin, round(g.mu + bi, 6) AS score
       FROM ib, g ORDER BY bi DESC, i LIMIT 10),
req AS (SELECT event_id, concat('U', CAST(user_id AS VARCHAR)) AS reviewerID FROM events WHERE event_type = 'click')
SELECT req.event_id, req.reviewerID, recs.rank, recs.asin, recs.score, 'personal' AS source
FROM req JOIN recs ON req.reviewerID = recs.reviewerID
UNION ALL
SELECT req.event_id, req.reviewerID, fb.rank, fb.asin, fb.score, 'fallback' AS source
FROM req CROSS JOIN fb WHERE req.reviewerID NOT IN (SELECT reviewerID FROM recs)"""


@query("serve_requests", oracle(SERVE_SQL, text=True))
def q_serve_requests(spark, sf):
    ratings = _filtered_ratings(spark, sf)
    # materialise the recommendation table once; every micro-batch joins the stored copy
    recs_path = scratch_path(spark, "recs-table")
    ms.grouped_lists(rc.recommend_bias(ratings, 10)).write.parquet(recs_path)
    recs = spark.read.parquet(recs_path)
    fallback = ms.fallback_array(rc.top_items(ratings, 10))
    events_path = f"{sf.rstrip('/')}/{{events.parquet}}"
    schema = spark.read.parquet(f"{sf.rstrip('/')}/events.parquet").schema
    clicks = (spark.readStream.schema(schema).parquet(events_path)
              .where(F.col("event_type") == "click")
              .select("event_id", F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("reviewerID")))
    served = ms.serve_requests(clicks, recs, fallback)
    sink = scratch_path(spark, "served")
    q = ms.sink_batches(served, sink, scratch_path(spark, "served-ckpt"))
    q.awaitTermination()
    return spark.read.parquet(sink).select("event_id", "reviewerID", "rank", "asin", "score", "source")
