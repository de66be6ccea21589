"""Recommender: id tables, deterministic split, bias model, exact top-k unseen items, ALS.

Scale notes
* Dense ids (M1) never sort the whole key set in one task: keys are range-partitioned, sorted
  within partitions, and each partition adds the row count of the partitions before it (a table
  with one row per partition, the only thing broadcast).
* Top-k unseen items for a global item order (bias model, popularity) needs no user x item
  product: user u's answer lies among the first ``k + n_u`` ranked items, so each user emits
  ``k + n_u`` candidate ranks (linear in the ratings). Long candidate ranges are cut into chunks
  that are spread over tasks, so a user holding a large share of all ratings is not one task.
* ALS (M3a) is Spark ML's blocked ALS. Factor models are asked for stated users only, scored in
  bounded blocks against all items (``recommend``); users without factors get the fallback.
"""

from __future__ import annotations


from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .stats import top_k_per_group

CHUNK = 4096


def dense_index(keys: DataFrame, order: list, out: str = "id") -> DataFrame:
    """0..n-1 over the distinct rows of ``keys`` in ``order`` (ties must not exist).

    Range partition + per-partition sort; each row's id is its position in its partition plus
    the row count of all earlier partitions. The partitioned rows are materialised with their
    partition and position first: the bounds of a range partitioning come from a sample, so a
    second evaluation could cut elsewhere, and sizes and positions must be of one and the same."""
    ranged = keys.repartitionByRange(*order).sortWithinPartitions(*order)
    tagged = cut_lineage(ranged.withColumn("_pid", F.spark_partition_id())
                         .withColumn("_m", F.monotonically_increasing_id()))
    sizes = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_m").alias("_m0"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", "_m0", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    # one row per partition: a proven bound, so broadcast
    return (tagged.join(F.broadcast(offsets), "_pid")
            .withColumn(out, (F.col("_off") + F.col("_m") - F.col("_m0")).cast("int"))
            .drop("_pid", "_m", "_m0", "_off"))


def build_id_index(df: DataFrame, key: str, out: str) -> DataFrame:
    """M1: (key, id) with ids 0..n-1 in key order."""
    return dense_index(df.select(key).where(F.col(key).isNotNull()).distinct(), [F.asc(key)], out)


def encode_ids(df: DataFrame, index: DataFrame, key: str, out: str, drop: bool = True) -> DataFrame:
    """Key -> int id (inner join with the id table)."""
    res = df.join(index, key)
    return res.drop(key) if drop else res


def decode_ids(df: DataFrame, index: DataFrame, key: str, id_col: str) -> DataFrame:
    """Int id -> key."""
    return df.join(index, id_col).drop(id_col)


def split_hash(seed: int, cols: list[str]):
    parts = [F.lit(f"{seed}")]
    for c in cols:
        parts += [F.lit("|"), F.col(c).cast("string")]
    return F.substring(F.md5(F.concat(*parts)), 1, 8)


def split_limits(weights=(0.7, 0.2, 0.1)) -> list[str]:
    """Hex limits of the cumulative shares on 32 bits ('b3333333', 'e6666666' for 70/20/10)."""
    total = sum(weights)
    limits, acc = [], 0.0
    for w in weights[:-1]:
        acc += w / total
        limits.append(format(min(int(acc * 2 ** 32), 2 ** 32 - 1), "08x"))
    return limits


def shuffle_split(df: DataFrame, seed: int = 42, weights=(0.7, 0.2, 0.1),
                  names=("train", "val", "test"), cols=("reviewerID", "asin", "unixReviewTime"),
                  out: str = "split") -> DataFrame:
    """M2: a stable split by hash of (seed, keys): no sort, no shuffle, same on every run and
    in every engine. Shares are expected values."""
    h = split_hash(seed, list(cols))
    limits = split_limits(weights)
    expr = None
    for lim, name in zip(limits, names):
        expr = F.when(h < F.lit(lim), F.lit(name)) if expr is None else expr.when(h < F.lit(lim), F.lit(name))
    return df.withColumn(out, expr.otherwise(F.lit(names[len(limits)])))


def global_mean(ratings: DataFrame, rating: str = "overall"):
    """Scalar subquery: sum / count (exact sums for integer ratings)."""
    r = ratings.where(F.col(rating).isNotNull())
    return r.select(F.sum(rating) / F.count(rating)).scalar()


def item_biases(ratings: DataFrame, mu, shrink: float = 10.0, item: str = "asin",
                rating: str = "overall") -> DataFrame:
    """M4 item part: ``(sum(r) - n*mu) / (n + shrink)``."""
    r = ratings.where(F.col(rating).isNotNull())
    agg = r.groupBy(item).agg(F.sum(rating).alias("_s"), F.count(rating).alias("n"))
    return agg.select(item, "n", ((F.col("_s") - F.col("n") * mu) / (F.col("n") + F.lit(shrink))).alias("bi"))


def user_biases(ratings: DataFrame, items: DataFrame, mu, shrink: float = 10.0, user: str = "reviewerID",
                item: str = "asin", rating: str = "overall") -> DataFrame:
    """M4 user part: ``sum(r - mu - bi) / (n + shrink)`` over the user's ratings."""
    r = ratings.where(F.col(rating).isNotNull()).join(items.select(item, "bi"), item)
    return r.groupBy(user).agg(
        (F.sum(F.col(rating) - mu - F.col("bi")) / (F.count(F.lit(1)) + F.lit(shrink))).alias("bu"),
        F.count(F.lit(1)).alias("n"))


def bias_model(ratings: DataFrame, shrink: float = 10.0, user: str = "reviewerID", item: str = "asin",
               rating: str = "overall"):
    """M4: (mu column, item table (item, n, bi), user table (user, bu, n))."""
    mu = global_mean(ratings, rating)
    items = item_biases(ratings, mu, shrink, item, rating)
    users = user_biases(ratings, items, mu, shrink, user, item, rating)
    return mu, items, users


def rank_items(items: DataFrame, score: str, item: str = "asin") -> DataFrame:
    """(item, score, rank) with rank 1.. by score desc, item asc."""
    ranked = dense_index(items.select(item, score), [F.desc(score), F.asc(item)], out="rank")
    return ranked.withColumn("rank", F.col("rank") + 1)


def top_unseen_by_rank(ratings: DataFrame, ranked: DataFrame, k: int = 10, user: str = "reviewerID",
                       item: str = "asin", chunk: int = CHUNK) -> DataFrame:
    """J5 + K3 for a global item order: for every user the first ``k`` ranked items not rated.

    Candidates are ranks 1..min(k + n_u, n_items); each user's range is cut into chunks of
    ``chunk`` ranks, chunks are spread round-robin, then expanded, joined to the ranking on the
    rank, anti-joined with what the user rated, and limited per user (partial limit first).
    The expanded side is far larger than the chunk rows it comes from, which is all Spark sees
    of its size, so both joins are fixed as sort-merge joins: no candidates are broadcast, and
    the low ranks that every user asks for are split by the skew rule."""
    n_items = ranked.select(F.count(F.lit(1))).scalar()
    need = ratings.groupBy(user).agg(F.count(F.lit(1)).alias("_n")).select(
        user, F.least(F.col("_n") + F.lit(k), n_items).alias("_need"))
    chunks = need.select(user, "_need", F.explode(F.sequence(
        F.lit(0), F.ceil(F.col("_need") / F.lit(chunk)).cast("int") - 1)).alias("_c"))
    chunks = chunks.repartition(user, "_c")
    cand = chunks.select(user, F.explode(F.sequence(
        F.col("_c") * chunk + 1, F.least((F.col("_c") + 1) * chunk, F.col("_need")).cast("int"))).alias("rank"))
    cand = cand.hint("merge").join(ranked.select("rank", item), "rank")
    unseen = cand.join(ratings.select(user, item).hint("merge"), [user, item], "left_anti")
    return top_k_per_group(unseen, [user], [F.asc("rank")], k, rank_col="pos").drop("rank") \
        .withColumnRenamed("pos", "rank")


def recommend_bias(ratings: DataFrame, k: int = 10, shrink: float = 10.0, user: str = "reviewerID",
                   item: str = "asin", rating: str = "overall") -> DataFrame:
    """M6 with the bias model: (user, rank, item, score) for every user, seen items left out.
    Score = mu + bi + bu, rounded to 6 places."""
    mu, items, users = bias_model(ratings, shrink, user, item, rating)
    ranked = rank_items(items, "bi", item)
    top = top_unseen_by_rank(ratings.select(user, item), ranked, k, user, item)
    return (top.join(items.select(item, "bi"), item).join(users.select(user, "bu"), user)
            .select(user, F.col("rank").cast("int").alias("rank"), item,
                    F.round(mu + F.col("bi") + F.col("bu"), 6).alias("score")))


def top_items(ratings: DataFrame, k: int = 10, shrink: float = 10.0, item: str = "asin",
              rating: str = "overall") -> DataFrame:
    """Fallback for an unknown user: the ``k`` best items by ``mu + bi``."""
    mu = global_mean(ratings, rating)
    items = item_biases(ratings, mu, shrink, item, rating)
    top = items.orderBy(F.desc("bi"), F.asc(item)).limit(k)
    return top.select(F.row_number().over(Window.orderBy(F.desc("bi"), F.asc(item))).cast("int").alias("rank"),
                      item, F.round(mu + F.col("bi"), 6).alias("score"))


def sample_user(ratings: DataFrame, seed: int = 42, user: str = "reviewerID") -> DataFrame:
    """M8: the user with the lowest md5(seed|user): deterministic 'random' pick."""
    h = F.md5(F.concat(F.lit(f"{seed}|"), F.col(user)))
    return ratings.select(user).distinct().select(user, h.alias("h")).orderBy("h", user).limit(1)


def reviews_of(df: DataFrame, items: DataFrame, item: str = "asin", bounded: bool = True) -> DataFrame:
    """All rows of the given items. ``bounded`` marks a top-k list (broadcast)."""
    keys = items.select(item).distinct()
    return df.join(F.broadcast(keys) if bounded else keys, item, "left_semi")


# ---- matrix factorisation (M3a) ----

def interactions(ratings: DataFrame, user: str = "reviewerID", item: str = "asin", rating: str = "overall",
                 users: DataFrame | None = None, items: DataFrame | None = None):
    """F6 features: (user int, item int, rating float, y double) with y min-max scaled, plus the
    two id tables."""
    from .prep import minmax_scale
    users = users if users is not None else build_id_index(ratings, user, "user")
    items = items if items is not None else build_id_index(ratings, item, "item")
    enc = encode_ids(encode_ids(ratings.where(F.col(rating).isNotNull()), users, user, "user", drop=False),
                     items, item, "item", drop=False)
    enc = enc.withColumn("rating", F.col(rating).cast("float"))
    enc = minmax_scale(enc, "rating", "y")
    return enc, users, items


#: Ratings of an ALS block on average: a task holds its ratings and the factors of all that they name.
ALS_RATINGS = 2_500_000


def als_blocks(ratings: int) -> int:
    """Blocks of users, and of items: Spark's 10, and more where there are many ratings."""
    return max(10, ratings // ALS_RATINGS)


def fit_als(train: DataFrame, rank: int = 40, max_iter: int = 5, reg: float = 0.1, seed: int = 42,
            target: str = "y", checkpoint_interval: int = 2):
    """Spark ML ALS on (user, item, target)."""
    from pyspark.ml.recommendation import ALS
    from ..session import checkpoint_dir
    checkpoint_dir(train.sparkSession)
    blocks = als_blocks(train.count())
    als = ALS(rank=rank, maxIter=max_iter, regParam=reg, userCol="user", itemCol="item", ratingCol=target,
              coldStartStrategy="drop", nonnegative=False, seed=seed, checkpointInterval=checkpoint_interval,
              numUserBlocks=blocks, numItemBlocks=blocks)
    return als.fit(train)


def als_factors(model) -> tuple[DataFrame, DataFrame]:
    """The model's factor tables (user, w, b) and (item, w, b), in the form of M3b's; ALS has no
    biases."""
    def table(factors, key):
        return factors.select(F.col("id").alias(key), F.col("features").cast("array<double>").alias("w"),
                              F.lit(0.0).alias("b"))
    return table(model.userFactors, "user"), table(model.itemFactors, "item")


def attach_factors(pairs: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """(user, item, ...) with ``wu``, ``bu``, ``wi``, ``bi``. No pair is lost: a user or item
    without factors has null vectors and bias 0."""
    return (pairs.join(users.select("user", F.col("w").alias("wu"), F.col("b").alias("bu")), "user", "left")
            .join(items.select("item", F.col("w").alias("wi"), F.col("b").alias("bi")), "item", "left")
            .withColumns({"bu": F.coalesce("bu", F.lit(0.0)), "bi": F.coalesce("bi", F.lit(0.0))}))


def score_pairs(pairs: DataFrame, users: DataFrame, items: DataFrame, logistic: bool = False) -> DataFrame:
    """M5: ``score`` = u.v + bu + bi for each pair (its sigmoid if ``logistic``); the product is 0
    where a side has no factors. ``cold`` marks those pairs."""
    j = attach_factors(pairs, users, items)
    cold = F.col("wu").isNull() | F.col("wi").isNull()
    dot = F.aggregate(F.zip_with("wu", "wi", lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)
    z = F.coalesce(dot, F.lit(0.0)) + F.col("bu") + F.col("bi")
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-z)) if logistic else z
    return j.withColumns({"score": score, "cold": cold}).drop("wu", "wi", "bu", "bi")


def rmse(model, data: DataFrame, target: str = "y") -> DataFrame:
    """M7: root mean squared error of the model on all pairs of ``data`` as a one-row table
    (rmse, n, cold); a pair with an unknown user or item is predicted by 0 and counted in ``cold``."""
    pred = score_pairs(data, *als_factors(model))
    return pred.agg(F.sqrt(F.avg(F.pow(F.col("score") - F.col(target), 2))).alias("rmse"),
                    F.count(F.lit(1)).alias("n"), F.count_if("cold").alias("cold"))


#: Requested users and candidate items that meet in one task, and users that are scored there at once.
USER_BLOCK = 4096
ITEM_BLOCK = 8192
USERS_AT_ONCE = 512
#: Item blocks that one round looks at, at most.
ROUND_BLOCKS = 256


def _score_block(k: int):
    def run(group):
        """The ``k`` best unseen items of the block for each user of the block."""
        import numpy as np
        import pandas as pd

        users, items = group[group["kind"] == 0], group[group["kind"] == 1].sort_values("item")
        out = {"user": [], "item": [], "score": []}
        if len(users) and len(items):
            seen = group[group["kind"] == 2]
            row = {u: i for i, u in enumerate(users["user"])}
            seen_row = seen["user"].map(row).to_numpy(int)
            seen_column = np.searchsorted(items["item"].to_numpy(), seen["item"].to_numpy())
            order = np.argsort(seen_row, kind="stable")
            seen_row, seen_column = seen_row[order], seen_column[order]
            wi, bi, names = np.stack(items["w"]).T, items["b"].to_numpy(), items["item"].to_numpy()
            for lo in range(0, len(users), USERS_AT_ONCE):
                some = users.iloc[lo:lo + USERS_AT_ONCE]
                z = np.stack(some["w"]) @ wi + some["b"].to_numpy()[:, None] + bi
                a, b = np.searchsorted(seen_row, [lo, lo + len(some)])
                z[seen_row[a:b] - lo, seen_column[a:b]] = -np.inf
                # what is not below a user's k-th best score, here or in the rounds before (ties stay), is all that is sorted
                bar = some["kth"].to_numpy(float).copy()
                if z.shape[1] > k:
                    first = np.isneginf(bar)
                    if first.any():
                        bar[first] = np.partition(z[first], z.shape[1] - k, axis=1)[:, z.shape[1] - k]
                at, column = np.nonzero((z >= bar[:, None]) & np.isfinite(z))
                score = z[at, column]
                order = np.lexsort((column, -score, at))  # ties: the smaller item first
                at, column, score = at[order], column[order], score[order]
                place = np.arange(len(at)) - np.searchsorted(at, at)
                out["user"].append(some["user"].to_numpy()[at[place < k]])
                out["item"].append(names[column[place < k]])
                out["score"].append(score[place < k])
        out = {c: np.concatenate(x) if x else np.empty(0) for c, x in out.items()}
        return pd.DataFrame(out).astype({"user": "int64", "item": "int64", "score": "float64"})
    return run


def _norm(w: str):
    return F.sqrt(F.aggregate(w, F.lit(0.0), lambda acc, x: acc + x * x))


def recommend(requested: DataFrame, users: DataFrame, items: DataFrame, seen: DataFrame, k: int = 10,
              logistic: bool = False, item_block: int = ITEM_BLOCK, log: list | None = None) -> DataFrame:
    """M6 (J5 + J6 + M5 + K3): (user, rank, item, score), the ``k`` best unseen items of each
    requested user, for any factor tables (user, w, b) and (item, w, b). Exact.

    Items stand in blocks by falling vector norm, each with its largest norm and bias. By
    Cauchy-Schwarz no item of a block scores above |u| * norm + bias, so a user whose ``k``-th score
    beats that is done with the block, and one whose score beats the bound of all that is left is done.
    Rounds look at 1, 2, 4, ... blocks; only users that still need one of them are sent there, and an
    item block is copied once for every group of such users. A task scores a group against a block as a
    matrix product, drops what was seen and hands on at most ``k`` rows per user; no (user, item) pair
    becomes a row. The driver sees one row per item block. Users without factors are not answered here:
    see :func:`recommend_all`. ``log`` gets one entry per round: its blocks, users and (user, block) pairs."""
    ask = requested.select("user").where("user IS NOT NULL").distinct().join(users.select("user", "w", "b"), "user")
    active = cut_lineage(ask.select("user", "w", "b", _norm("w").alias("norm"), F.lit(float("-inf")).alias("kth")))
    placed = dense_index(items.select("item", "w", "b", _norm("w").alias("norm")), [F.desc("norm"), F.asc("item")], "place")
    placed = cut_lineage(placed.withColumn("block", F.floor(F.col("place") / item_block).cast("int")).drop("place"))
    meta = placed.groupBy("block").agg(F.max("norm").alias("norm"), F.max("b").alias("b")).orderBy("block").collect()
    rest = [(0.0, float("-inf"))] * (len(meta) + 1)  # the largest norm and bias from a block on
    for j in range(len(meta) - 1, -1, -1):
        rest[j] = max(rest[j + 1][0], meta[j]["norm"]), max(rest[j + 1][1], meta[j]["b"])

    def may_beat(norm, bias):
        bound = F.col("norm") * norm + bias + F.col("b")
        return bound + F.lit(1e-9) * (F.abs(bound) + 1) >= F.col("kth")  # ties and rounding stay in

    none, cores = F.lit(None), requested.sparkSession.sparkContext.defaultParallelism
    best, start, width = None, 0, 1
    while start < len(meta):
        stop = min(len(meta), start + width)
        n_active = active.count()
        if not n_active:
            break
        table = F.array(*[F.struct(F.lit(j).alias("block"), F.lit(meta[j]["norm"]).alias("norm"), F.lit(meta[j]["b"]).alias("bias"))
                          for j in range(start, stop)])
        # an item block is copied for each group: large groups, but work for all cores
        groups = F.lit(max(1, -(-n_active // USER_BLOCK), min(-(-n_active // USERS_AT_ONCE), cores)))
        needed = F.filter(table, lambda t: may_beat(t["norm"], t["bias"]))
        u = cut_lineage(active.select("user", "w", "b", "kth", F.pmod(F.xxhash64("user"), groups).cast("int").alias("ub"), F.explode(needed["block"]).alias("ib")))
        if log is not None:
            log.append({"blocks": (start, stop), "users": n_active, "pairs": u.count()})
        i = (placed.where(F.col("block").between(start, stop - 1)).withColumnRenamed("block", "ib")
             .join(u.select("ub", "ib").distinct(), "ib")
             .select(F.lit(1).alias("kind"), "ub", "ib", none.cast("long").alias("user"), F.col("item").cast("long"), "w", "b", none.cast("double").alias("kth")))
        s = (seen.select("user", "item").distinct().join(placed.select("item", F.col("block").alias("ib")), "item")
             .join(u.select("user", "ib", "ub"), ["user", "ib"])
             .select(F.lit(2).alias("kind"), "ub", "ib", F.col("user").cast("long"), F.col("item").cast("long"),
                     none.cast("array<double>").alias("w"), none.cast("double").alias("b"), none.cast("double").alias("kth")))
        rows = u.select(F.lit(0).alias("kind"), "ub", "ib", F.col("user").cast("long"), none.cast("long").alias("item"), "w", "b", "kth")
        found = rows.unionByName(i).unionByName(s).groupBy("ub", "ib").applyInPandas(_score_block(k), "user long, item long, score double")
        found = found if best is None else best.unionByName(found)
        best = cut_lineage(top_k_per_group(found, ["user"], [F.desc("score"), F.asc("item")], k).select("user", "item", "score", "rank"))
        kth = best.where(F.col("rank") == k).select("user", F.col("score").alias("kth_"))
        best = best.drop("rank")
        active = (active.join(kth, "user", "left").withColumn("kth", F.coalesce("kth_", "kth")).drop("kth_"))
        active = cut_lineage(active.where(may_beat(F.lit(rest[stop][0]), F.lit(rest[stop][1]))))
        start, width = stop, min(2 * width, ROUND_BLOCKS)
    if best is None:
        best = requested.sparkSession.createDataFrame([], "user long, item long, score double")
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("score"))) if logistic else F.col("score")
    return top_k_per_group(best, ["user"], [F.desc("score"), F.asc("item")], k).select(
        F.col("user").cast("int").alias("user"), F.col("rank").cast("int").alias("rank"),
        F.col("item").cast("int").alias("item"), score.alias("score"))


def recommend_all(requested: DataFrame, users: DataFrame, items: DataFrame, seen: DataFrame,
                  fallback: DataFrame, k: int = 10, logistic: bool = False) -> DataFrame:
    """M6, complete: (user, rank, item, score, source). Users with factors are answered by
    :func:`recommend` (``personal``); the others get the first ``k`` items of ``fallback`` (item,
    score, rank) that they have not seen (``fallback``)."""
    personal = recommend(requested, users, items, seen, k, logistic).withColumn("source", F.lit("personal"))
    cold = requested.select("user").where("user IS NOT NULL").distinct().join(users.select("user"), "user", "left_anti")
    cold = cut_lineage(cold)
    cold_seen = seen.select("user", "item").distinct().join(cold, "user", "left_semi")
    some = top_unseen_by_rank(cold_seen, fallback, k, "user", "item")
    none = (cold.join(cold_seen.select("user").distinct(), "user", "left_anti")
            .select("user", F.explode(F.sequence(F.lit(1), F.lit(k))).alias("rank"))
            # k rows, whatever the tables
            .join(F.broadcast(fallback.where(F.col("rank") <= k).select("rank", "item")), "rank"))
    other = (some.select("user", "rank", "item").unionByName(none.select("user", "rank", "item"))
             .join(fallback.select("item", "score"), "item"))
    return personal.unionByName(other.select("user", F.col("rank").cast("int").alias("rank"), F.col("item").cast("int").alias("item"),
                                             F.col("score").cast("double").alias("score"), F.lit("fallback").alias("source")))


def fallback_items(enc: DataFrame, target: str = "y", shrink: float = 10.0) -> DataFrame:
    """(item, score, rank): all items by shrunken mean of ``target``, for users without factors."""
    mu = global_mean(enc, target)
    scored = item_biases(enc, mu, shrink, "item", target).select("item", (mu + F.col("bi")).alias("score"))
    return rank_items(scored, "score", "item")
