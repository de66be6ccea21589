import random

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ratewise.operators import recommend as rc

RATINGS = "reviewerID string, asin string, overall double"


def brute_force_bias(rows, k, shrink=10.0):
    """Python reference: score every unseen item for every user."""
    mu = sum(r for _, _, r in rows) / len(rows)
    items, users = {}, {}
    for u, i, r in rows:
        items.setdefault(i, []).append(r)
    bi = {i: (sum(v) - len(v) * mu) / (len(v) + shrink) for i, v in items.items()}
    for u, i, r in rows:
        users.setdefault(u, []).append(r - mu - bi[i])
    bu = {u: sum(v) / (len(v) + shrink) for u, v in users.items()}
    seen = {(u, i) for u, i, _ in rows}
    out = {}
    for u in users:
        cands = sorted((i for i in items if (u, i) not in seen), key=lambda i: (-bi[i], i))[:k]
        out[u] = [(i, round(mu + bi[i] + bu[u], 6)) for i in cands]
    return out


def test_dense_index(spark):
    keys = [f"K{random.Random(i).randint(0, 10**6)}" for i in range(300)]
    df = spark.createDataFrame([(k,) for k in keys], "key string")
    got = {r.key: r.id for r in rc.build_id_index(df, "key", "id").collect()}
    want = {k: i for i, k in enumerate(sorted(set(keys)))}
    assert got == want


def test_split_disjoint_complete_stable(spark):
    df = spark.range(5000).select(F.concat(F.lit("U"), (F.col("id") % 97).cast("string")).alias("reviewerID"),
                                  F.concat(F.lit("B"), F.col("id").cast("string")).alias("asin"),
                                  F.lit(1).alias("unixReviewTime"))
    s = rc.shuffle_split(df)
    counts = {r.split: r["count"] for r in s.groupBy("split").count().collect()}
    assert sum(counts.values()) == 5000 and set(counts) == {"train", "val", "test"}
    assert 3300 < counts["train"] < 3700 and 800 < counts["val"] < 1200
    assert sorted(s.collect()) == sorted(rc.shuffle_split(df).collect())
    assert rc.split_limits() == ["b3333333", "e6666666"]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 12), st.integers(1, 5)), min_size=1, max_size=60),
       st.integers(1, 4))
def test_bias_topk_matches_brute_force(spark, raw, k):
    rows = [(f"U{u}", f"B{i:02d}", float(r)) for u, i, r in raw]
    # one hot user who rated a third of everything, plus a user who rated every item
    rows += [("HOT", f"B{i:02d}", 3.0) for i in range(0, 13, 2)] + [("ALL", f"B{i:02d}", 4.0) for i in range(13)]
    df = spark.createDataFrame(rows, RATINGS)
    got = {}
    ranked = rc.rank_items(rc.item_biases(df, rc.global_mean(df)), "bi")
    for r in rc.top_unseen_by_rank(df.select("reviewerID", "asin"), ranked, k, chunk=2).collect():
        got.setdefault(r.reviewerID, []).append((r.rank, r.asin))
    recs = rc.recommend_bias(df, k).collect()
    want = brute_force_bias(rows, k)
    by_user = {}
    for r in recs:
        by_user.setdefault(r.reviewerID, []).append((r.rank, r.asin, r.score))
    for u, lst in want.items():
        mine = sorted(by_user.get(u, []))
        assert [(a, s) for _, a, s in mine] == lst, u
        assert [x for x, _, _ in mine] == list(range(1, len(lst) + 1))
        assert [a for _, a in sorted(got.get(u, []))] == [a for a, _ in lst]
    assert "ALL" not in by_user  # rated everything: nothing left to recommend


def test_top_items_and_sample_user(spark):
    df = spark.createDataFrame([("U1", "B1", 5.0), ("U2", "B1", 5.0), ("U1", "B2", 1.0)], RATINGS)
    top = rc.top_items(df, 2).collect()
    assert [r.asin for r in top] == ["B1", "B2"] and [r.rank for r in top] == [1, 2]
    assert rc.sample_user(df).count() == 1


def test_recommend_matches_brute_force_for_requested_users(spark):
    """One user holds a third of the ratings, one is outside the factor tables, one has no rating."""
    rnd = random.Random(3)
    seen = {(0, i) for i in range(45)} | {(u, rnd.randrange(60)) for u in range(1, 12) for _ in range(8)} | {(50, 3)}
    users = [(u, [rnd.gauss(0, 1) for _ in range(3)], rnd.gauss(0, 1)) for u in range(12)]
    items = [(i, [rnd.gauss(0, 1) for _ in range(3)], rnd.gauss(0, 1)) for i in range(60)]
    uf = spark.createDataFrame(users, "user int, w array<double>, b double")
    itf = spark.createDataFrame(items, "item int, w array<double>, b double")
    enc = spark.createDataFrame([(u, i, 1.0 / (1 + i)) for u, i in seen], "user int, item int, y double")
    ask = spark.createDataFrame([(0,), (3,), (3,), (50,), (60,), (None,)], "user int")
    out = rc.recommend_all(ask, uf, itf, enc, rc.fallback_items(enc), k=5).collect()
    got = {}
    for r in sorted(out, key=lambda r: r["rank"]):
        got.setdefault(r.user, []).append((r["rank"], r.item, r.source))
    for u in (0, 3):
        z = {i: sum(a * b for a, b in zip(users[u][1], w)) + users[u][2] + b for i, w, b in items if (u, i) not in seen}
        want = sorted(z, key=lambda i: (-z[i], i))[:5]
        assert got[u] == [(k + 1, i, "personal") for k, i in enumerate(want)]
    order = [r.item for r in rc.fallback_items(enc).orderBy("rank").collect()]
    assert [i for _, i, _ in got[60]] == order[:5]
    assert [i for _, i, _ in got[50]] == [i for i in order if i != 3][:5]
    assert set(got) == {0, 3, 50, 60} and {s for _, _, s in got[60]} == {"fallback"}


def test_als_answers_are_complete(spark):
    rnd = random.Random(3)
    rows = [(f"U{u}", f"B{i}", float(rnd.randint(1, 5))) for u in range(30) for i in range(20) if rnd.random() < 0.5]
    enc, users, items = rc.interactions(spark.createDataFrame(rows, RATINGS))
    model = rc.fit_als(enc.where("user > 1").select("user", "item", "y"), rank=4, max_iter=3)
    uf, itf = rc.als_factors(model)
    out = rc.recommend_all(users, uf, itf, enc, rc.fallback_items(enc), k=5).collect()
    seen = {(r.user, r.item) for r in enc.select("user", "item").collect()}
    assert all((r.user, r.item) not in seen for r in out)
    assert {r.user for r in out} == {r.user for r in users.collect()}
    assert {r.user for r in out if r.source == "fallback"} == {0, 1}
    scored = rc.rmse(model, enc).first()
    assert scored.rmse < 1.0 and scored.n == enc.count() and scored.cold == enc.where("user <= 1").count()


def test_ids_do_not_depend_on_exchange_reuse(spark):
    import __spark_entry__ as entry
    from tools.check_oracle import compare
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        for name in ("user_index", "item_index", "bias_top10"):
            assert compare(spark, "/root/testdata/sf0.001", name, entry)
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_als_has_more_blocks_where_there_are_many_ratings(spark, monkeypatch):
    from pyspark.ml.recommendation import ALS
    asked = []
    real = ALS.fit
    monkeypatch.setattr(ALS, "fit", lambda self, df: asked.append((self.getNumUserBlocks(), self.getNumItemBlocks())) or real(self, df))
    train = spark.createDataFrame([(u, i, float((u + i) % 2)) for u in range(9) for i in range(7)], "user int, item int, y double")
    rc.fit_als(train, 2, 1)
    monkeypatch.setattr(rc, "ALS_RATINGS", 3)
    rc.fit_als(train, 2, 1)
    assert asked == [(10, 10), (21, 21)]
    assert rc.als_blocks(0) == 10


def test_users_are_scored_some_at_a_time(spark, monkeypatch):
    import numpy as np
    rng = np.random.default_rng(2)
    u, i = rng.normal(size=(30, 3)), rng.normal(size=(40, 3))
    users = spark.createDataFrame([(n, [float(x) for x in w], 0.1) for n, w in enumerate(u)], "user int, w array<double>, b double")
    items = spark.createDataFrame([(n, [float(x) for x in w], 0.0) for n, w in enumerate(i)], "item int, w array<double>, b double")
    seen = spark.createDataFrame([(n, (n * 7) % 40) for n in range(30)], "user int, item int")
    key = lambda df: sorted((r.user, r["rank"], r.item, round(r.score, 9)) for r in df.collect())
    whole = key(rc.recommend(users, users, items, seen, 4, item_block=16))
    monkeypatch.setattr(rc, "USERS_AT_ONCE", 4)
    monkeypatch.setattr(rc, "USER_BLOCK", 30)
    assert key(rc.recommend(users, users, items, seen, 4, item_block=16)) == whole and len(whole) == 120
    z = u @ i.T
    z[np.arange(30), (np.arange(30) * 7) % 40] = -np.inf
    assert [(a, b, c) for a, b, c, _ in whole] == [(n, k + 1, int(x)) for n in range(30) for k, x in enumerate(np.argsort(-z[n])[:4])]
