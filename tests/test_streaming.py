import json
import os

from ratewise.streaming import messages as ms


def _msgs(spark, values):
    return spark.createDataFrame([(f"U{i}", v) for i, v in enumerate(values)], "key string, value string")


def test_decode_explode_edge_cases(spark):
    twelve = json.dumps({"asin": [f"B{i}" for i in range(12)], "overall": [float(i) for i in range(12)]})
    three = json.dumps({"asin": ["A", "B", "C"], "overall": [1.0, 2.0, 3.0]})
    unequal = json.dumps({"asin": ["A", "B", "C"], "overall": [1.0]})
    df = ms.decode_messages(_msgs(spark, [twelve, three, unequal, "{bad json"]))
    assert [r.ok for r in df.orderBy("key").collect()] == [True, True, True, False]
    rows = ms.explode_recommendations(df, 10).collect()
    counts = {}
    for r in rows:
        counts[r.key] = counts.get(r.key, 0) + 1
    assert counts == {"U0": 10, "U1": 3, "U2": 1}
    assert sorted(r.rank for r in rows if r.key == "U0") == list(range(1, 11))


def test_encode_decode_roundtrip(spark):
    recs = spark.createDataFrame([("U1", 2, "B2", 3.5), ("U1", 1, "B1", 4.0), ("U2", 1, "B9", 1.0)],
                                 "reviewerID string, rank int, asin string, score double")
    enc = ms.encode_messages(recs)
    v = {r.key: json.loads(r.value) for r in enc.collect()}
    assert v["U1"] == {"asin": ["B1", "B2"], "overall": [4.0, 3.5]}
    back = ms.explode_recommendations(ms.decode_messages(enc)).collect()
    assert sorted((r.key, r.rank, r.asin, r.overall) for r in back) == sorted(
        (r.reviewerID, r.rank, r.asin, r.score) for r in recs.collect())


def test_stream_equals_batch_and_replay_is_idempotent(spark, tmp):
    topic = os.path.join(tmp, "topic")
    recs = spark.createDataFrame([("U1", 1, "B1", 4.0), ("U2", 1, "B2", 3.0)],
                                 "reviewerID string, rank int, asin string, score double")
    ms.publish(ms.encode_messages(recs), topic)
    sink, ckpt = os.path.join(tmp, "sink"), os.path.join(tmp, "ckpt")
    q = ms.sink_batches(ms.explode_recommendations(ms.decode_messages(ms.consume(spark, topic, starting_offsets="earliest"))), sink, ckpt)
    q.awaitTermination()
    streamed = sorted(tuple(r) for r in spark.read.parquet(sink).drop("query_id", "batch_id").collect())
    batch = sorted(tuple(r) for r in ms.explode_recommendations(
        ms.decode_messages(spark.read.schema("key string, value string").json(topic))).collect())
    assert streamed == batch
    # a second query with a new checkpoint starts at batch 0 again: it must not touch the first's rows
    q = ms.sink_batches(ms.explode_recommendations(ms.decode_messages(
        ms.consume(spark, topic, starting_offsets="earliest"))), sink, ckpt + "2")
    q.awaitTermination()
    rows = spark.read.parquet(sink)
    assert rows.count() == 2 * len(batch) and rows.select("query_id").distinct().count() == 2
    # the same checkpoint once more: nothing new, nothing doubled
    q = ms.sink_batches(ms.explode_recommendations(ms.decode_messages(
        ms.consume(spark, topic, starting_offsets="earliest"))), sink, ckpt)
    q.awaitTermination()
    assert spark.read.parquet(sink).count() == 2 * len(batch)
    # a consumer that starts now does not see what was published before
    late = ms.sink_batches(ms.consume(spark, topic), sink + "3", ckpt + "3")
    late.awaitTermination()
    assert not os.path.exists(sink + "3") or spark.read.schema("key string").parquet(sink + "3").count() == 0


def test_rejected_messages(spark):
    df = ms.decode_messages(_msgs(spark, ['{"asin": ["A", "B"], "overall": [1.0]}', "{bad", '{"asin": ["A"], "overall": [1.0]}']))
    assert sorted((r.key, r.reason) for r in ms.rejected_messages(df).collect()) == [
        ("U0", "lists of unequal length"), ("U1", "malformed")]


def test_serve_requests_fallback(spark):
    recs = spark.createDataFrame([("U1", 1, "B1", 4.0)], "reviewerID string, rank int, asin string, score double")
    top = spark.createDataFrame([(1, "B7", 4.5), (2, "B8", 4.4)], "rank int, asin string, score double")
    req = spark.createDataFrame([(1, "U1"), (2, "U9")], "event_id long, reviewerID string")
    out = ms.serve_requests(req, recs, ms.fallback_array(top)).collect()
    got = sorted((r.event_id, r.rank, r.asin, r.source) for r in out)
    assert got == [(1, 1, "B1", "personal"), (2, 1, "B7", "fallback"), (2, 2, "B8", "fallback")]
