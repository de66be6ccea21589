"""Recommendation messages and the streams that carry them.

Messages are JSON ``{"asin": [...], "overall": [...]}`` (parallel lists), keyed by user. The
same operators run on a batch DataFrame or a streaming one. Kafka is used through Spark's
Kafka source/sink when its package is on the classpath; the file source/sink has the same
shape and is what the tests use.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import MESSAGE_SCHEMA

TOPIC = "recommendation_topic"


def encode_messages(recs: DataFrame, user: str = "reviewerID", item: str = "asin", score: str = "score",
                    rank: str = "rank") -> DataFrame:
    """One message per user: (key, value). Each group is one user's top-k (bounded)."""
    grouped = recs.groupBy(user).agg(F.sort_array(F.collect_list(F.struct(rank, item, score))).alias("_r"))
    value = F.to_json(F.struct(F.transform("_r", lambda s: s[item]).alias("asin"),
                               F.transform("_r", lambda s: s[score].cast("double")).alias("overall")))
    return grouped.select(F.col(user).alias("key"), value.alias("value"))


def decode_messages(messages: DataFrame, value: str = "value") -> DataFrame:
    """JSON text -> (asin array, overall array); text that does not parse gives nulls
    (``ok`` = false) so it can be set aside."""
    parsed = F.from_json(F.col(value).cast("string"), MESSAGE_SCHEMA)
    out = messages.withColumn("_m", parsed)
    return (out.withColumn("ok", F.col("_m").isNotNull() & F.col("_m.asin").isNotNull())
            .select("*", F.col("_m.asin").alias("asin"), F.col("_m.overall").alias("overall")).drop("_m"))


def explode_recommendations(decoded: DataFrame, limit: int = 10, key: str = "key") -> DataFrame:
    """R2: pair the lists by position, first ``limit`` entries: (key, rank, asin, overall).
    Lists of unequal length pair up to the shorter one (:func:`rejected_messages` has them too);
    short lists are fine."""
    pairs = F.arrays_zip(F.slice("asin", 1, limit).alias("a"), F.slice("overall", 1, limit).alias("o"))
    ok = decoded.where(F.col("ok"))
    out = ok.select(key, F.posexplode(pairs).alias("pos", "p"))
    return (out.where(F.col("p.a").isNotNull() & F.col("p.o").isNotNull())
            .select(key, (F.col("pos") + 1).cast("int").alias("rank"), F.col("p.a").alias("asin"),
                    F.col("p.o").alias("overall")))


def rejected_messages(decoded: DataFrame, key: str = "key", value: str = "value") -> DataFrame:
    """(key, value, reason): messages that did not parse, or whose lists are of unequal length or hold
    null entries and so lose some in :func:`explode_recommendations`."""
    uneven = F.col("ok") & (F.coalesce(F.size("asin"), F.lit(0)) != F.coalesce(F.size("overall"), F.lit(0)))
    holes = F.exists("asin", lambda x: x.isNull()) | F.exists("overall", lambda x: x.isNull())
    reason = (F.when(~F.col("ok"), "malformed").when(uneven, "lists of unequal length")
              .when(F.col("ok") & F.coalesce(holes, F.lit(False)), "null entries"))
    return decoded.select(key, value, reason.alias("reason")).where("reason IS NOT NULL")


def publish(messages: DataFrame, target: str, fmt: str = "json", topic: str = TOPIC, **options) -> None:
    """Batch publish. ``fmt='kafka'``: ``target`` is the bootstrap servers; ``log``: a folder log;
    otherwise a folder of JSON lines (one record per message)."""
    if fmt == "log":
        from . import folder_log
        folder_log.append(messages, target)
    elif fmt == "kafka":
        (messages.select(F.col("key").cast("string"), F.col("value").cast("string")).write.format("kafka")
         .option("kafka.bootstrap.servers", target).option("topic", topic).options(**options).save())
    else:
        messages.write.mode("append").format(fmt).options(**options).save(target)


def first_start(spark: SparkSession, checkpoint: str) -> int:
    """Milliseconds of the first start of the consumer with this checkpoint: written beside the
    checkpoint by the first start, read by all later ones."""
    path = f"{checkpoint.rstrip('/')}-first-start"
    spark.range(1).select(F.lit(str(int(time.time() * 1000))).alias("value")).coalesce(1).write.mode("ignore").text(path)
    return int(spark.read.text(path).first()["value"])


def consume(spark: SparkSession, source: str, fmt: str = "json", topic: str = TOPIC,
            starting_offsets: str = "latest", checkpoint: str | None = None, **options) -> DataFrame:
    """A stream of (key, value) messages: those that arrive from the first start on
    (``latest``, S11) or all (``earliest``, replay, S12).

    ``latest`` holds for the first start with a checkpoint only: messages that are published while the
    consumer is down are read after it. Kafka keeps that in its offsets. Files are told apart by their
    modification time and the time of the first start, kept beside ``checkpoint``; without one, every start
    is a first start. ``fmt="log"`` reads a folder log (``folder_log.py``), whose offsets are positions."""
    if starting_offsets not in ("latest", "earliest"):
        raise ValueError(f"starting_offsets: {starting_offsets}")
    if fmt == "kafka":
        return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", source)
                .option("subscribe", topic).option("startingOffsets", starting_offsets).options(**options).load()
                .select(F.col("key").cast("string"), F.col("value").cast("string")))
    if fmt == "log":
        from . import folder_log
        if starting_offsets == "latest" and not checkpoint:
            raise ValueError("reading a log from the latest message on needs the checkpoint of the query, to keep the start")
        return folder_log.read_stream(spark, source, starting_offsets, checkpoint)
    stream = spark.readStream.schema("key string, value string").format(fmt).options(**options).load(source)
    if starting_offsets == "latest":
        start = F.timestamp_millis(F.lit(first_start(spark, checkpoint) if checkpoint else int(time.time() * 1000)))
        stream = stream.where(F.col("_metadata.file_modification_time") >= start)
    return stream.select("key", "value")


def sink_batches(stream: DataFrame, path: str, checkpoint: str, trigger_available_now: bool = True,
                 outputs=None):
    """Write each micro-batch into its own ``query_id=<id>/batch_id=<n>`` folder, overwriting it.
    A batch replayed after a failure rewrites the same folder, so rows are never doubled; a query
    with a new checkpoint counts its batches from 0 again but has another id, so it never
    overwrites rows of an earlier one. ``outputs`` maps a folder below ``path`` to a function of
    the batch (one sink for several results); the batch itself is written by default."""
    def write(batch: DataFrame, batch_id: int):
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        batch = batch.persist()
        for folder, of in (outputs or {"": lambda x: x}).items():
            target = f"{path}/{folder}" if folder else path
            of(batch).write.mode("overwrite").parquet(f"{target}/query_id={query}/batch_id={batch_id}")
        batch.unpersist()

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if trigger_available_now else writer
    return writer.start()


def fallback_array(top: DataFrame, rank: str = "rank", item: str = "asin", score: str = "score"):
    """The unknown-user list as a literal array. ``top`` is a top-k result (bounded by k)."""
    rows = top.orderBy(rank).collect()
    return F.array(*[F.struct(F.lit(int(r[rank])).alias("rank"), F.lit(r[item]).alias("asin"),
                              F.lit(float(r[score])).alias("score")) for r in rows])


def grouped_lists(recs: DataFrame, user: str = "reviewerID") -> DataFrame:
    """(user, _recs): one row per user with the bounded top-k list; store it once, so that no
    micro-batch groups the recommendations again."""
    return recs.groupBy(user).agg(F.sort_array(F.collect_list(F.struct(
        F.col("rank").cast("int").alias("rank"), "asin", F.col("score").cast("double").alias("score")))).alias("_recs"))


def serve_requests(requests: DataFrame, recs: DataFrame, fallback, user: str = "reviewerID") -> DataFrame:
    """Each request (a row with ``user``) gets that user's stored top-k; a user without
    stored recommendations gets ``fallback`` (see :func:`fallback_array`). Works on a stream
    (stream-static join) or a batch: one left join with one row per user, whose list is bounded.
    ``recs`` is a recommendation table or its :func:`grouped_lists`."""
    lists = recs if "_recs" in recs.columns else grouped_lists(recs, user)
    source = F.when(F.col("_recs").isNull(), "fallback").otherwise("personal")
    joined = requests.join(lists, user, "left").withColumn("source", source)
    return joined.select(*requests.columns, "source", F.inline(F.coalesce("_recs", fallback)))
