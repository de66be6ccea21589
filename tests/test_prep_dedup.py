from hypothesis import given, settings, strategies as st

from ratewise.operators import dedup, prep
from ratewise.schema import REVIEW_SCHEMA


def _df(spark, rows):
    return spark.createDataFrame(rows, REVIEW_SCHEMA)


def row(asin="B1", overall=4.0, verified=True, text="t", user="U1", summary="s", ts=1, vote=None):
    return (asin, overall, verified, text, user, summary, ts, vote)


def test_parse_vote(spark):
    df = _df(spark, [row(vote=None), row(vote="7"), row(vote="1,234"), row(vote="n/a")])
    assert [r.vote for r in prep.parse_vote(df).collect()] == [None, 7.0, 1234.0, None]
    assert [r.vote for r in prep.parse_vote(df, strict=True).collect()] == [None, 7.0, None, None]


def test_fill_vote_by_product_and_global(spark):
    df = _df(spark, [row("B1", vote="2", ts=1), row("B1", vote="5", ts=2), row("B1", vote=None, ts=3),
                     row("B2", vote=None, ts=4)])
    out = {r.unixReviewTime: r.vote for r in prep.fill_vote_by_product(df).collect()}
    assert out == {1: 2, 2: 5, 3: 3, 4: 3}  # B2 has no vote: global mean 3.5 -> 3
    g = {r.unixReviewTime: r.vote for r in prep.fill_vote_global(df).collect()}
    assert g[3] == 3.5 and g[4] == 3.5


def test_merge_summary_and_feedback(spark):
    df = _df(spark, [row(text="a", summary="b"), row(text="a", summary=None, ts=2), row(overall=None, ts=3)])
    out = prep.label_feedback(prep.merge_summary(df)).collect()
    assert [r.reviewText for r in out] == ["a b", "a", "t s"]
    assert [r.feedback for r in out] == ["good", "good", "bad"]
    assert "summary" not in prep.merge_summary(df).columns


def test_minmax_equal_ratings(spark):
    df = _df(spark, [row(overall=3.0), row(overall=3.0, ts=2)])
    assert [r.y for r in prep.minmax_scale(df).collect()] == [None, None]


def test_incomplete_and_verified(spark):
    df = _df(spark, [row(), row(summary=None, ts=2), row(verified=None, ts=3), row(verified=False, ts=4)])
    assert prep.incomplete_rows(df, ["summary"]).count() == 1
    assert prep.only_verified(df).count() == 2


def test_dedup(spark):
    df = _df(spark, [row(), row(), row(text="zzz"), row(text="aaa")])
    assert dedup.drop_exact_duplicates(df).count() == 3
    kept = dedup.drop_duplicate_reviews(df).collect()
    assert len(kept) == 1 and kept[0].reviewText == "aaa"


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["B1", "B2"]), st.sampled_from(["U1", "U2"]), st.integers(0, 2),
                          st.sampled_from(["x", "y", None])), max_size=20))
def test_dedup_idempotent_and_keyed(spark, rows):
    df = _df(spark, [row(a, 4.0, True, t, u, "s", ts, None) for a, u, ts, t in rows])
    once = dedup.drop_duplicate_reviews(df)
    twice = dedup.drop_duplicate_reviews(once)
    assert sorted(map(repr, once.collect())) == sorted(map(repr, twice.collect()))
    assert once.count() == df.select("asin", "reviewerID", "unixReviewTime").distinct().count()


def test_numeric_columns(spark):
    df = spark.createDataFrame([(1.0, 1, None, True), (2.0, 1, 3.0, False)], "a double, b int, c double, d boolean")
    rows = {r.column: r.keep for r in prep.numeric_columns(df, max_columns=1).collect()}
    assert rows == {"a": True, "b": False, "c": False}
    every = {r.column: r.keep for r in prep.numeric_columns(df).collect()}
    assert every == {"a": True, "b": False, "c": False}  # booleans are no numbers
