"""Registered recommender queries (ids, split, bias model, top-k, ALS)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import recommend as rc
from .profile_queries import R
from .registry import oracle, query

SPLIT_SQL = ("CASE WHEN substr(md5(concat('42|', reviewerID, '|', asin, '|', cast(unixReviewTime AS VARCHAR))), 1, 8) "
             "< 'b3333333' THEN 'train' WHEN substr(md5(concat('42|', reviewerID, '|', asin, '|', "
             "cast(unixReviewTime AS VARCHAR))), 1, 8) < 'e6666666' THEN 'val' ELSE 'test' END")


def _ratings(spark, sf):
    return R(spark, sf).select("reviewerID", "asin", "overall", "unixReviewTime")


@query("user_index", oracle("""
SELECT reviewerID, CAST(row_number() OVER (ORDER BY reviewerID) - 1 AS INTEGER) AS user
FROM (SELECT DISTINCT reviewerID FROM reviews WHERE reviewerID IS NOT NULL)"""))
def q_user_index(spark, sf):
    return rc.build_id_index(_ratings(spark, sf), "reviewerID", "user")


@query("item_index", oracle("""
SELECT asin, CAST(row_number() OVER (ORDER BY asin) - 1 AS INTEGER) AS item
FROM (SELECT DISTINCT asin FROM reviews WHERE asin IS NOT NULL)"""))
def q_item_index(spark, sf):
    return rc.build_id_index(_ratings(spark, sf), "asin", "item")


@query("encoded_ratings", oracle("""
WITH u AS (SELECT reviewerID, CAST(row_number() OVER (ORDER BY reviewerID) - 1 AS INTEGER) AS user
           FROM (SELECT DISTINCT reviewerID FROM reviews)),
i AS (SELECT asin, CAST(row_number() OVER (ORDER BY asin) - 1 AS INTEGER) AS item FROM (SELECT DISTINCT asin FROM reviews)),
s AS (SELECT min(CAST(overall AS FLOAT)) AS lo, max(CAST(overall AS FLOAT)) AS hi FROM reviews)
SELECT u.user, i.item, r.unixReviewTime, CAST(r.overall AS FLOAT) AS rating,
       CASE WHEN s.hi = s.lo THEN NULL ELSE (CAST(CAST(r.overall AS FLOAT) AS DOUBLE) - s.lo) / (s.hi - s.lo) END AS y
FROM reviews r JOIN u ON r.reviewerID = u.reviewerID JOIN i ON r.asin = i.asin, s"""))
def q_encoded_ratings(spark, sf):
    enc, _, _ = rc.interactions(_ratings(spark, sf))
    return enc.select("user", "item", "unixReviewTime", "rating", "y")


@query("train_split", oracle(f"SELECT reviewerID, asin, unixReviewTime, {SPLIT_SQL} AS split FROM reviews"))
def q_train_split(spark, sf):
    return rc.shuffle_split(_ratings(spark, sf)).select("reviewerID", "asin", "unixReviewTime", "split")


@query("split_sizes", oracle(f"SELECT {SPLIT_SQL} AS split, count(*) AS n FROM reviews GROUP BY 1"))
def q_split_sizes(spark, sf):
    return rc.shuffle_split(_ratings(spark, sf)).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


BIAS_CTES = """
WITH r AS (SELECT reviewerID AS u, asin AS i, overall AS y FROM reviews WHERE overall IS NOT NULL),
g AS (SELECT sum(y) / count(y) AS mu FROM r),
ib AS (SELECT r.i, count(r.y) AS n, (sum(r.y) - count(r.y) * g.mu) / (count(r.y) + CAST(10 AS DOUBLE)) AS bi
       FROM r, g GROUP BY r.i, g.mu),
ub AS (SELECT r.u, sum(r.y - g.mu - ib.bi) / (count(*) + CAST(10 AS DOUBLE)) AS bu, count(*) AS n
       FROM r JOIN ib ON r.i = ib.i, g GROUP BY r.u)"""


@query("item_bias", oracle(BIAS_CTES + "\nSELECT i AS asin, n, round(bi, 6) AS bi FROM ib"))
def q_item_bias(spark, sf):
    r = _ratings(spark, sf)
    mu = rc.global_mean(r)
    return rc.item_biases(r, mu).select("asin", "n", F.round("bi", 6).alias("bi"))


@query("user_bias", oracle(BIAS_CTES + "\nSELECT u AS reviewerID, n, round(bu, 6) AS bu FROM ub"))
def q_user_bias(spark, sf):
    _, _, users = rc.bias_model(_ratings(spark, sf))
    return users.select("reviewerID", "n", F.round("bu", 6).alias("bu"))


@query("bias_top10", oracle(BIAS_CTES + """,
seen AS (SELECT DISTINCT u, i FROM r),
cand AS (SELECT ub.u, ib.i, ib.bi, ub.bu FROM ub CROSS JOIN ib
         WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.u = ub.u AND s.i = ib.i)),
ranked AS (SELECT u, i, bi, bu, row_number() OVER (PARTITION BY u ORDER BY bi DESC, i) AS rank FROM cand)
SELECT u AS reviewerID, CAST(rank AS INTEGER) AS rank, i AS asin, round(g.mu + bi + bu, 6) AS score
FROM ranked, g WHERE rank <= 10"""))
def q_bias_top10(spark, sf):
    return rc.recommend_bias(_ratings(spark, sf), 10)


@query("unknown_user_top10", oracle(BIAS_CTES + """
SELECT CAST(row_number() OVER (ORDER BY bi DESC, i) AS INTEGER) AS rank, i AS asin, round(g.mu + bi, 6) AS score
FROM ib, g ORDER BY bi DESC, i LIMIT 10"""))
def q_unknown_user_top10(spark, sf):
    return rc.top_items(_ratings(spark, sf), 10)


@query("sample_user", oracle("""
SELECT reviewerID, md5(concat('42|', reviewerID)) AS h FROM (SELECT DISTINCT reviewerID FROM reviews)
ORDER BY h, reviewerID LIMIT 1"""))
def q_sample_user(spark, sf):
    return rc.sample_user(_ratings(spark, sf))


@query("sample_user_item_reviews", oracle(BIAS_CTES + """,
pick AS (SELECT reviewerID FROM (SELECT DISTINCT reviewerID FROM reviews) ORDER BY md5(concat('42|', reviewerID)), reviewerID LIMIT 1),
seen AS (SELECT DISTINCT i FROM r WHERE u = (SELECT reviewerID FROM pick)),
top AS (SELECT i FROM ib WHERE i NOT IN (SELECT i FROM seen) ORDER BY bi DESC, i LIMIT 10)
SELECT asin, overall, reviewerID, unixReviewTime FROM reviews WHERE asin IN (SELECT i FROM top)"""))
def q_sample_user_item_reviews(spark, sf):
    ratings = _ratings(spark, sf)
    pick = rc.sample_user(ratings).select("reviewerID")
    items = rc.item_biases(ratings, rc.global_mean(ratings))
    # the picked user's 10 best unseen items under the model fitted on all ratings (one row: broadcast)
    seen = ratings.join(F.broadcast(pick), "reviewerID", "left_semi").select("asin").distinct()
    top = items.join(seen, "asin", "left_anti").orderBy(F.desc("bi"), F.asc("asin")).limit(10)
    return rc.reviews_of(ratings, top, bounded=True).select("asin", "overall", "reviewerID", "unixReviewTime")


def _requested(spark, sf, users):
    """The users that ask: those of the events' purchases (a stated set; all items are scored)."""
    from ..sources.fixtures import table
    asked = (table(spark, sf, "events").where("event_type = 'purchase'")
             .select(F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("reviewerID")).distinct())
    return users.join(asked, "reviewerID", "left_semi")


@query("als_top10")
def q_als_top10(spark, sf):
    from . import jobs
    model, enc, users, items, _ = jobs.train_job(_ratings(spark, sf), rank=40, max_iter=5)
    return jobs.als_answers(model, enc, users, items, _requested(spark, sf, users), 10)


@query("als_val_rmse")
def q_als_val_rmse(spark, sf):
    from . import jobs
    _, _, _, _, val_rmse = jobs.train_job(_ratings(spark, sf), rank=40, max_iter=5)
    return val_rmse


def _split(spark, sf):
    from ..session import stored
    # the ratings are read several times: once from their tables, then as stored
    ratings = stored(_ratings(spark, sf), "ratings")
    users, items = (stored(rc.build_id_index(ratings, key, out), "ids") for key, out in (("reviewerID", "user"), ("asin", "item")))
    enc, users, items = rc.interactions(ratings, users=users, items=items)
    return stored(rc.shuffle_split(enc), "split"), users, items


@query("logistic_mf_loss")
def q_logistic_mf_loss(spark, sf):
    from ..operators import mf
    split, _, _ = _split(spark, sf)
    _, _, history = mf.fit_logistic_mf(split.where(F.col("split") == "train"), split.where(F.col("split") == "val"))
    return history.select("epoch", F.round("train_bce", 6).alias("train_bce"), F.round("val_bce", 6).alias("val_bce"),
                          "val_n", "val_cold")


# ---- factor models against SQL: the start factors are a rule, and one step is plain arithmetic

MF_RANK = 4


def _normal_sql(seed: int, key: str, d: int) -> str:
    h = f"md5('{seed}|' || CAST({key} AS VARCHAR) || '|{d}')"
    part = lambda at: f"CAST('0x' || substr({h}, {at}, 8) AS BIGINT)"
    return (f"sqrt(-2.0 * ln(({part(1)} + 1) / CAST(4294967297 AS DOUBLE))) "
            f"* cos(2 * pi() * ({part(9)} / CAST(4294967296 AS DOUBLE)))")


def _factors_sql(name: str, key: str, seed: int) -> str:
    cols = ", ".join(f"sqrt(2.0 / (SELECT count(DISTINCT {key}) FROM tr)) * {_normal_sql(seed, key, d)} AS w{d}" for d in range(MF_RANK))
    return f"{name} AS MATERIALIZED (SELECT {key}, {cols} FROM (SELECT DISTINCT {key} FROM tr))"


MF_CTES = f"""
WITH uix AS (SELECT reviewerID, CAST(row_number() OVER (ORDER BY reviewerID) - 1 AS INTEGER) AS user
             FROM (SELECT DISTINCT reviewerID FROM reviews)),
iix AS (SELECT asin, CAST(row_number() OVER (ORDER BY asin) - 1 AS INTEGER) AS item FROM (SELECT DISTINCT asin FROM reviews)),
enc AS (SELECT uix.user, iix.item, r.reviewerID, r.asin, r.unixReviewTime, (r.overall - 1) / 4 AS y, {SPLIT_SQL.replace('reviewerID', 'r.reviewerID').replace('asin', 'r.asin').replace('unixReviewTime', 'r.unixReviewTime')} AS split
        FROM reviews r JOIN uix ON r.reviewerID = uix.reviewerID JOIN iix ON r.asin = iix.asin),
tr AS (SELECT * FROM enc WHERE split = 'train'),
{_factors_sql('fu', 'user', 42)},
{_factors_sql('fi', 'item', 43)}"""

_DOT = " + ".join(f"coalesce(fu.w{d} * fi.w{d}, 0)" for d in range(MF_RANK))


def _start(spark, sf):
    from ..operators import mf
    split, users, items = _split(spark, sf)
    train = split.where(F.col("split") == "train")
    return split, train, mf.start_factors(train, MF_RANK), users, items


@query("mf_epoch0_bce", oracle(MF_CTES + f""",
s AS (SELECT y, 1 / (1 + exp(-({_DOT}))) AS p, fu.user IS NULL OR fi.item IS NULL AS cold
      FROM (SELECT * FROM enc WHERE split = 'val') v LEFT JOIN fu ON v.user = fu.user LEFT JOIN fi ON v.item = fi.item)
SELECT round(avg(-(y * ln(p) + (1 - y) * ln(1 - p))), 6) AS bce, count(*) AS n, count(*) FILTER (WHERE cold) AS cold FROM s"""))
def q_mf_epoch0_bce(spark, sf):
    from ..operators import mf
    split, _, (users, items), _, _ = _start(spark, sf)
    out = mf.bce(split.where(F.col("split") == "val"), users, items)
    return out.select(F.round("bce", 6).alias("bce"), "n", "cold")


@query("mf_scores", oracle(MF_CTES + f"""
SELECT t.reviewerID, t.asin, t.unixReviewTime, round(1 / (1 + exp(-({_DOT}))), 6) AS p, fu.user IS NULL OR fi.item IS NULL AS cold
FROM (SELECT * FROM enc WHERE split = 'test') t LEFT JOIN fu ON t.user = fu.user LEFT JOIN fi ON t.item = fi.item"""))
def q_mf_scores(spark, sf):
    from ..operators import mf
    split, _, (users, items), uix, iix = _start(spark, sf)
    scored = mf.predict(split.where(F.col("split") == "test").select("user", "item", "unixReviewTime"), users, items)
    named = rc.decode_ids(rc.decode_ids(scored, uix, "reviewerID", "user"), iix, "asin", "item")
    return named.select("reviewerID", "asin", "unixReviewTime", F.round("p", 6).alias("p"), "cold")


def _grad_sql(key: str, own: str, other: str) -> str:
    sums = ", ".join(f"sum(e * {other}w{d}) AS g{d}" for d in range(MF_RANK))
    return f"g{own} AS (SELECT {key}, {sums}, sum(e) AS gb FROM sc GROUP BY {key})"


def _moved_sql(key: str, own: str) -> str:
    move = lambda g: f"0.001 * ({g}) / (sqrt(({g}) * ({g})) + 1e-7)"  # noqa: E731  the first Adam step
    cols = ", ".join(f"round(f.w{d} - {move(f'g.g{d} + 2e-6 * f.w{d}')}, 6) AS w{d}" for d in range(MF_RANK))
    return f"SELECT '{key}' AS side, f.{key} AS id, {cols}, round(-{move('g.gb')}, 6) AS b FROM f{own} f JOIN g{own} g USING ({key})"


@query("mf_one_step", oracle(MF_CTES + f""",
sc AS (SELECT tr.user, tr.item, (1 / (1 + exp(-({_DOT}))) - y) / (SELECT count(*) FROM tr) AS e,
       {', '.join(f'fu.w{d} AS uw{d}, fi.w{d} AS iw{d}' for d in range(MF_RANK))}
       FROM tr JOIN fu ON tr.user = fu.user JOIN fi ON tr.item = fi.item),
{_grad_sql('user', 'u', 'i')},
{_grad_sql('item', 'i', 'u')}
{_moved_sql('user', 'u')}
UNION ALL
{_moved_sql('item', 'i')}"""))
def q_mf_one_step(spark, sf):
    from ..operators import mf
    _, train, (users, items), _, _ = _start(spark, sf)
    moved = mf.step(train.select("user", "item", "y"), users, items, 1, rank=MF_RANK)

    def flat(table, key):
        return table.select(F.lit(key).alias("side"), F.col(key).alias("id"),
                            *[F.round(F.col("w")[d], 6).alias(f"w{d}") for d in range(MF_RANK)], F.round("b", 6).alias("b"))
    return flat(moved[0], "user").unionByName(flat(moved[1], "item"))


@query("recommend_users", oracle(MF_CTES + f""",
ask AS (SELECT DISTINCT uix.user, uix.reviewerID FROM uix JOIN events e ON uix.reviewerID = 'U' || CAST(e.user_id AS VARCHAR)
        WHERE e.event_type = 'purchase'),
sc AS (SELECT ask.reviewerID, fi.item, {_DOT} AS z FROM ask JOIN fu ON ask.user = fu.user CROSS JOIN fi
       WHERE NOT EXISTS (SELECT 1 FROM enc WHERE enc.user = ask.user AND enc.item = fi.item)),
rk AS (SELECT *, row_number() OVER (PARTITION BY reviewerID ORDER BY z DESC, item) AS rank FROM sc)
SELECT reviewerID, CAST(rank AS INTEGER) AS rank, iix.asin, round(1 / (1 + exp(-z)), 6) AS score
FROM rk JOIN iix ON rk.item = iix.item WHERE rank <= 10"""))
def q_recommend_users(spark, sf):
    split, _, (users, items), uix, iix = _start(spark, sf)
    recs = rc.recommend(_requested(spark, sf, uix), users, items, split, 10, logistic=True)
    named = rc.decode_ids(rc.decode_ids(recs, uix, "reviewerID", "user"), iix, "asin", "item")
    return named.select("reviewerID", "rank", "asin", F.round("score", 6).alias("score"))
