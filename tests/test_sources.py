import json

from pyspark.sql import functions as F

from ratewise.operators import prep
from ratewise.schema import LOAD_CONTRACT, REVIEW_COLUMNS, REVIEW_SCHEMA
from ratewise.sources import reviews as io
from ratewise.sources.contract import check_contract

FULL = {"asin": "B1", "overall": 5.0, "verified": True, "reviewText": "great", "reviewerID": "U1",
        "summary": "ok", "unixReviewTime": 1400000000, "vote": "3"}


def _lines(tmp):
    no_vote = {k: v for k, v in FULL.items() if k != "vote"}
    oops = dict(FULL, overall="oops")
    path = f"{tmp}/in.json"
    with open(path, "w") as f:
        f.write(json.dumps(FULL) + "\n{bad json\n" + json.dumps(no_vote) + "\n" + json.dumps(oops) + "\n")
    return path


def test_permissive_read_and_dropna(spark, tmp):
    df = io.read_reviews(spark, _lines(tmp))
    assert df.columns == REVIEW_COLUMNS
    rows = df.collect()
    assert len(rows) == 4
    assert any(all(r[c] is None for c in REVIEW_COLUMNS) for r in rows)  # malformed -> all null
    assert sum(1 for r in rows if r["asin"] == "B1" and r["overall"] is None) == 1  # "oops" -> null
    assert prep.drop_incomplete(df).count() == 1


def test_quarantine_keeps_bad_lines_whole(spark, tmp):
    good, bad = io.read_reviews(spark, _lines(tmp), quarantine=True)
    lines = sorted(r["line"] for r in bad.collect())
    assert len(lines) == 2
    assert "{bad json" in lines
    assert any('"oops"' in x for x in lines)
    assert good.count() == 2


def test_records_array(spark, tmp):
    path = f"{tmp}/arr.json"
    with open(path, "w") as f:
        json.dump([dict(FULL, _id="x1"), dict(FULL, _id="x2", asin="B2")], f, indent=1)
    df = io.read_records_array(spark, path)
    assert "_id" not in df.columns and df.count() == 2


def test_contract_and_clustered_write(spark, tmp):
    df = spark.createDataFrame([tuple(FULL[c] for c in REVIEW_COLUMNS),
                                tuple(dict(FULL, summary=None, reviewerID="U2")[c] for c in REVIEW_COLUMNS)],
                               schema=REVIEW_SCHEMA)
    valid, rejected = check_contract(df, LOAD_CONTRACT)
    assert valid.count() == 1
    assert [r["reason"] for r in rejected.collect()] == ["summary is null"]
    rej = io.write_table(df, f"{tmp}/t", contract=LOAD_CONTRACT, cluster_by="reviewerID")
    assert rej.count() == 1
    assert io.read_user_rows(spark, f"{tmp}/t", "U1").count() == 1


def test_contract_type_mismatch(spark):
    df = spark.createDataFrame([("B1", "5")], "asin string, overall string")
    _, rejected = check_contract(df, {"asin": LOAD_CONTRACT["asin"], "overall": LOAD_CONTRACT["overall"]})
    assert rejected.first()["reason"] == "overall is string, not double"


def test_training_extract_is_deterministic(spark):
    df = spark.range(2000).select(F.concat(F.lit("U"), F.col("id").cast("string")).alias("reviewerID"),
                                  F.lit("B1").alias("asin"), F.lit(1).alias("unixReviewTime"))
    a = io.training_extract(df, 0.25).collect()
    b = io.training_extract(df, 0.25).collect()
    assert a == b and 350 < len(a) < 650
