from ratewise.operators import density
from ratewise.schema import REVIEW_SCHEMA


def test_one_pass_semantics(spark):
    r = lambda a, u, ts=1400000000: (a, 4.0, True, "long enough", u, "s", ts, "1")
    rows = [r("I1", "U1"), r("I1", "U2"), r("I1", "U3"),     # I1 popular
            r("I2", "U1"), r("I2", "U2"), r("I2", "U3"),     # I2 popular
            r("I3", "U1"),                                   # I3 rare: removed by J1
            r("I4", "U4"), r("I4", "U4", 1400000001), r("I4", "U5"),  # I4 popular, U5 dropped by J2
            r("I1", "U4"),
            r("I5", "U6"), r("I5", "U6", 1), r("I5", "U6", 2)]  # old rows removed by the time filter
    df = spark.createDataFrame(rows, REVIEW_SCHEMA)
    out = density.density_filter(df, since_ts=1300000000)
    users = {x.reviewerID for x in out.collect()}
    # U1 keeps I1, I2 (2 rows after J1) -> dropped; U4 has 3 rows -> kept
    assert users == {"U4"}
    # I4 falls to 2 ratings after J2 but is kept: one pass
    assert {x.asin for x in out.collect()} == {"I1", "I4"}
    assert out.columns == ["reviewerID", "asin", "overall", "reviewText"]


def test_null_rating_not_counted(spark):
    rows = [("I1", None, True, "xxxxx", "U1", "s", 1, "1"), ("I1", 1.0, True, "xxxxx", "U2", "s", 1, "1"),
            ("I1", 2.0, True, "xxxxx", "U3", "s", 1, "1")]
    df = spark.createDataFrame(rows, REVIEW_SCHEMA)
    assert density.item_counts(df).first().num_ratings == 2
    assert density.keep_popular_items(df, 3).count() == 0
