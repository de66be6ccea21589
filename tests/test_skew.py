"""Skewed inputs: one item, one user and one group of copies each hold about a third of all rows.
Results must equal a plain Python computation (nothing dropped, capped or sampled)."""

import random
from collections import Counter, defaultdict

from ratewise.operators import dedup, density, prep
from ratewise.operators import recommend as rc
from ratewise.schema import REVIEW_SCHEMA


def _rows(n=900, seed=7):
    rnd = random.Random(seed)
    rows = []
    for k in range(n):
        if k % 3 == 0:
            asin, user = "HOT", f"U{rnd.randint(0, 60)}"
        elif k % 3 == 1:
            asin, user = f"B{rnd.randint(0, 80)}", "HOTU"
        else:
            asin, user = f"B{rnd.randint(0, 80)}", f"U{rnd.randint(0, 60)}"
        vote = None if rnd.random() < 0.3 else str(rnd.randint(0, 9))
        rows.append((asin, float(rnd.randint(1, 5)), True, "text long", user, "s", 1400000000 + k, vote))
    copies = [("COPY", 3.0, True, "same", "UC", "s", 1, "1")] * (n // 2)
    return rows, copies


def test_density_under_skew(spark):
    rows, _ = _rows()
    df = spark.createDataFrame(rows, REVIEW_SCHEMA)
    got = sorted((r.reviewerID, r.asin) for r in density.density_filter(df, since_ts=0).collect())
    items = Counter(a for a, *_ in rows)
    j1 = [r for r in rows if items[r[0]] >= 3]
    users = Counter(r[4] for r in j1)
    want = sorted((r[4], r[0]) for r in j1 if users[r[4]] >= 3)
    assert got == want


def test_vote_fill_and_dedup_under_skew(spark):
    rows, copies = _rows()
    df = spark.createDataFrame(rows + copies, REVIEW_SCHEMA)
    assert dedup.drop_exact_duplicates(df).count() == len(rows) + 1
    assert dedup.drop_duplicate_reviews(df).count() == len(rows) + 1
    votes = defaultdict(list)
    for r in rows + copies:
        if r[7] is not None:
            votes[r[0]].append(float(r[7]))
    got = {(r.asin, r.unixReviewTime, r.reviewerID): r.vote for r in prep.fill_vote_by_product(df).collect()}
    all_votes = [v for vs in votes.values() for v in vs]
    for r in rows:
        if r[7] is not None:
            want = int(float(r[7]))
        elif votes[r[0]]:
            want = int(sum(votes[r[0]]) / len(votes[r[0]]))
        else:  # no vote for the item at all: global mean
            want = int(sum(all_votes) / len(all_votes))
        assert got[(r[0], r[6], r[4])] == want


def test_bias_topk_under_skew(spark):
    rows, _ = _rows(300)
    ratings = spark.createDataFrame([(r[4], r[0], r[1]) for r in rows], "reviewerID string, asin string, overall double")
    recs = rc.recommend_bias(ratings, 5).collect()
    seen = {(r[4], r[0]) for r in rows}
    assert all((r.reviewerID, r.asin) not in seen for r in recs)
    per_user = Counter(r.reviewerID for r in recs)
    n_items = len({r[0] for r in rows})
    for u in {r[4] for r in rows}:
        unseen = n_items - len({a for uu, a in seen if uu == u})
        assert per_user[u] == min(5, unseen)


def test_hot_user_is_clustered_over_several_files(spark, tmp):
    from ratewise.sources import reviews as io
    df = spark.range(40000).selectExpr("concat('B', id % 5000) AS asin", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('U', id % 997) END AS reviewerID",
                                       "CAST(id % 5 AS double) AS overall", "CAST(id AS int) AS unixReviewTime")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        io.write_table(df, f"{tmp}/clustered", cluster_by="reviewerID")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    hot = io.read_user_rows(spark, f"{tmp}/clustered", "hot")
    assert hot.count() == 13334
    assert hot.selectExpr("_metadata.file_name").distinct().count() > 1
