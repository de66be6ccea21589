import json

from pyspark.sql import functions as F

from ratewise.plans import jobs
from ratewise.sources import reviews as io
from ratewise.sources.fixtures import reviews_view

SF = "/root/testdata/sf0.001"


def _write_json(spark, tmp):
    path = f"{tmp}/reviews_json"
    reviews_view(spark, SF, True).write.json(path)
    with open(f"{path}/bad.json", "w") as f:
        f.write("{bad json\n")
    return path


def test_load_and_clean_jobs(spark, tmp):
    src = _write_json(spark, tmp)
    counts = jobs.load_job(spark, src, f"{tmp}/loaded")
    assert counts["written"] == 3318  # rows without any null (FIXTURES)
    assert counts == {"malformed": 1, "incomplete": 6000 - 3318, "duplicates": 0, "rejected": 0, "written": 3318}
    assert spark.read.parquet(f"{tmp}/loaded").count() == 3318
    assert [r.line for r in spark.read.parquet(f"{tmp}/loaded-rejects/malformed").collect()] == ["{bad json"]
    assert spark.read.parquet(f"{tmp}/loaded-rejects/contract").count() == 0
    rejected = jobs.clean_load_job(spark, src, f"{tmp}/clean")
    assert rejected.count() == 0
    clean = spark.read.parquet(f"{tmp}/clean")
    assert "summary" not in clean.columns and clean.where(F.col("vote").isNull()).count() == 0
    assert clean.where(~F.col("verified")).count() == 0


def test_density_job(spark, tmp):
    reviews_view(spark, SF, True).write.parquet(f"{tmp}/stored")
    rej = jobs.density_filter_job(spark, f"{tmp}/stored", f"{tmp}/filtered", since_ts=978307200)
    assert rej.count() == 0
    assert spark.read.parquet(f"{tmp}/filtered").count() == 601


def test_train_recommend_consume(spark, tmp):
    ratings = reviews_view(spark, SF, False).select("reviewerID", "asin", "overall", "unixReviewTime")
    model, enc, users, items, val = jobs.train_job(ratings, f"{tmp}/model", rank=4, max_iter=2)
    assert val.first().n > 0
    loaded = io.load_als(f"{tmp}/model/als")
    assert loaded.rank == 4
    for _ in range(2):  # a run that is repeated replaces its rows
        recs, item_reviews = jobs.recommend_job(loaded, enc, users, items, ratings, users, k=3,
                                                store=f"{tmp}/recs", run_id="a")
    jobs.ms.publish(jobs.ms.encode_messages(recs), f"{tmp}/topic")
    n_recs = recs.count()
    assert n_recs == 3 * users.count()
    assert spark.read.parquet(f"{tmp}/recs").count() == n_recs
    q = jobs.consume_job(spark, f"{tmp}/topic", f"{tmp}/sink", f"{tmp}/ckpt", starting_offsets="earliest")
    q.awaitTermination()
    assert spark.read.parquet(f"{tmp}/sink/rows").count() == n_recs
    assert spark.read.parquet(f"{tmp}/sink/rejects").count() == 0
    assert item_reviews.count() > 0


def test_eda_and_notebook_tables(spark):
    df = reviews_view(spark, SF, True)
    tables = jobs.eda_tables(df)
    assert tables["top_terms_by_rating"].count() == 100
    assert tables["rating_histogram"].count() == 10
    nb = jobs.notebook_tables(jobs.notebook_clean(df))
    assert nb["feedback_counts"].first().good > 0
    assert {r.column for r in nb["numeric_columns"].collect()} >= {"overall", "vote"}


def test_json_arrays_have_a_bounded_size(spark, tmp):
    from ratewise.plans import job_queries
    df = spark.range(3000).selectExpr("concat('i', id % 7) AS asin", "id").unionByName(
        spark.range(1000).selectExpr("'same' AS asin", "cast(1 AS long) AS id"))
    job_queries.write_arrays(df, f"{tmp}/arrays", rows=64)
    sizes = [len(json.loads(r.value)) for r in spark.read.option("wholetext", True).text(f"{tmp}/arrays").collect()]
    assert max(sizes) <= 64 and sum(sizes) == 4000
    back = io.read_records_array(spark, f"{tmp}/arrays").select("asin", "id")
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0
