"""Embedding near-dedup by an exact metric range join.

Unit vectors are at least as similar as a cosine ``c`` exactly if they are at most
``r = sqrt(2 - 2c)`` apart. Pivots cut the vectors of a label into cells (each vector belongs to
its nearest pivot). Two vectors of different cells that are within ``r`` lie within ``r`` of the
plane half way between the pivots, by the triangle inequality; a vector that near to a cell's
border is copied into the cell, unless it lies farther from the pivot than the cell's covering radius
and ``r`` together. Then every cell finds the links of its own vectors by itself.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ship, stored
from .components import components, local_roots

COSINE = 0.98
#: Distinct vectors of a label for each pivot. From ``MANY`` pivots on their number grows with the
#: square root of the vectors: finding a vector's cell and comparing a cell then cost about the same.
PER_PIVOT = 2048
MANY = 512
#: Vectors that one task assigns to pivots, and rows of a block that a cell is compared in.
DEAL = 16384
BLOCK = 2048
#: Rounding of a squared distance between unit vectors, allowed for at cell borders.
SLACK = 1e-9
#: The same for a distance that is added to another: its square is off by much less.
ROUND = 1e-12


def unit(vectors) -> np.ndarray:
    x = np.stack([np.asarray(v, np.float64) for v in vectors])
    x /= np.abs(x).max(axis=1, keepdims=True)  # squares of very large or small components stay finite
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def border(to_pivot: np.ndarray, pivots: np.ndarray, r: float) -> np.ndarray:
    """[vector, cell]: whether the vector is in the cell or may be within ``r`` of one that is.
    ``to_pivot`` holds squared distances."""
    home = to_pivot.argmin(axis=1)
    apart = np.sqrt(np.maximum(2 - 2 * pivots @ pivots.T, 0))[home]
    return to_pivot - to_pivot[np.arange(len(home)), home][:, None] <= 2 * r * apart + SLACK


def _farthest(vectors: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
    """For each cell: the largest distance of one of these vectors that is at home in it."""
    if not len(vectors) or not len(pivots):
        return pd.DataFrame({"label": [], "dim": [], "cell": [], "radius": []})
    p = unit(pivots.sort_values("rank")["embedding"])
    radius = np.full(len(p), -1.0)
    for lo in range(0, len(vectors), 4096):
        far = np.maximum(2 - 2 * unit(vectors["embedding"].iloc[lo:lo + 4096]) @ p.T, 0)
        np.maximum.at(radius, far.argmin(axis=1), np.sqrt(far.min(axis=1) + ROUND))
    cell = np.flatnonzero(radius >= 0)
    return pd.DataFrame({"label": vectors["label"].iloc[0], "dim": vectors["dim"].iloc[0], "cell": cell, "radius": radius[cell]})


def _assign(r: float):
    def run(vectors: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
        out = {"label": [], "dim": [], "cell": [], "home": [], "id": [], "weight": [], "embedding": []}
        if len(vectors) and len(pivots):
            pivots = pivots.sort_values("rank")
            p, cover = unit(pivots["embedding"]), pivots["radius"].to_numpy() + r
            for lo in range(0, len(vectors), 4096):
                some = vectors.iloc[lo:lo + 4096]
                x = unit(some["embedding"])
                far = np.maximum(2 - 2 * x @ p.T, 0)
                i, cell = np.nonzero(border(far, p, r) & (far <= cover * cover + SLACK))
                out["home"].append(far.argmin(axis=1)[i] == cell)
                out["cell"].append(cell)
                for c in ("label", "dim", "id", "weight", "embedding"):
                    out[c].append(some[c].to_numpy()[i])
        return pd.DataFrame({c: np.concatenate(v) if v else [] for c, v in out.items()})
    return run


def _compare(cosine: float):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        """Of one block of a cell's own vectors against one block of all its vectors: the weight
        linked to each own vector, and for each vector the smallest of its linked set (a star for
        each connected set of the block, not all its pairs)."""
        own, other = group[group["side"] == 0], group[group["side"] == 1]
        if not len(own) or not len(other):
            return pd.DataFrame({"id": [], "linked": [], "root": []}, dtype="int64")
        near = unit(own["embedding"]) @ unit(other["embedding"]).T >= cosine
        a, b = own["id"].to_numpy(), other["id"].to_numpy()
        near |= a[:, None] == b[None, :]
        linked = near @ other["weight"].to_numpy()
        la, lb = local_roots(near, a, b)
        joined = lb != b
        return pd.DataFrame({"id": np.concatenate([a, b[joined]]),
                             "linked": np.concatenate([linked, np.zeros(joined.sum(), np.int64)]),
                             "root": np.concatenate([la, lb[joined]])})
    return run


def links(classes: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(id, linked, root) partial results of ``classes`` (id, label, dim, weight, embedding)."""
    spark = classes.sparkSession
    ship(spark)
    r = math.sqrt(2 - 2 * cosine)
    group = ["label", "dim"]
    n = F.col("n")
    wanted = F.when(n <= MANY * PER_PIVOT, n / PER_PIVOT).otherwise(F.sqrt(n.cast("double")) * math.sqrt(MANY / PER_PIVOT))
    size = (classes.groupBy(*group).agg(F.count("*").alias("n"), F.min(F.struct(F.xxhash64("id"), "id"))["id"].alias("least"))
            .withColumn("every", F.greatest(F.floor(n / F.greatest(wanted, F.lit(1.0))), F.lit(1)))
            .withColumn("deals", F.ceil(n / DEAL).cast("int")))
    size = stored(size, "sizes")
    # pivots: every so many-th vector by hash, and one at least; their number is that of the cells
    chosen = (classes.join(size.select(*group, "every", "least", "deals"), group)
              .where((F.pmod(F.xxhash64("id"), F.col("every")) == 0) | (F.col("id") == F.col("least"))))
    rank = F.row_number().over(Window.partitionBy(*group).orderBy("id")) - 1
    chosen = stored(chosen.select(*group, "id", "deals", "embedding").withColumn("rank", rank), "pivots")
    deal = F.explode(F.sequence(F.lit(0), F.col("deals") - 1)).alias("deal")
    dealt = stored(classes.join(size.select(*group, "deals"), group)
                   .withColumn("deal", F.pmod(F.xxhash64("id"), F.col("deals")).cast("int")).drop("deals"), "dealt")
    keys = [*group, "deal"]
    pivots = chosen.select(*group, deal, "rank", "embedding")
    radius = (dealt.groupBy(*keys).cogroup(pivots.groupBy(*keys)).applyInPandas(_farthest, "label string, dim int, cell int, radius double")
              .groupBy(*group, F.col("cell").alias("rank")).agg(F.max("radius").alias("radius")))
    # a cell in which no vector is at home (its pivot is the twin of another) takes none
    covered = stored(chosen.join(radius, [*group, "rank"], "left").withColumn("radius", F.coalesce("radius", F.lit(-r))), "covered")
    pivots = covered.select(*group, deal, "rank", "embedding", "radius")
    kind = classes.schema["embedding"].dataType.simpleString()
    celled = stored(dealt.groupBy(*keys).cogroup(pivots.groupBy(*keys)).applyInPandas(
        _assign(r), f"label string, dim int, cell int, home boolean, id long, weight long, embedding {kind}"), "cells")

    cell = [*group, "cell"]
    blocks = (celled.groupBy(*cell).agg(F.count("*").alias("all"), F.count_if("home").alias("own"))
              .where("own > 0")
              .select(*cell, F.ceil(F.col("own") / BLOCK).cast("int").alias("own_blocks"),
                      F.ceil(F.col("all") / BLOCK).cast("int").alias("all_blocks")))
    rows = celled.join(stored(blocks, "blocks"), cell)
    at = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    kept = [*cell, "id", "weight", "embedding"]
    own = rows.where("home").select(*kept, F.lit(0).alias("side"), at("own_blocks").alias("i"), each("all_blocks").alias("j"))
    other = rows.select(*kept, F.lit(1).alias("side"), each("own_blocks").alias("i"), at("all_blocks").alias("j"))
    return own.unionByName(other).groupBy(*cell, "i", "j").applyInPandas(_compare(cosine), "id long, linked long, root long")


def near_duplicates(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding",
                    label: str = "label", cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``vectors``.

    Vectors are linked if their labels are equal and not null, they have as many components, and
    their cosine in double precision is at least ``cosine``. A vector that is null, empty or zero,
    or holds a null or non-finite component, is linked with nothing. Rows that repeat a vector are
    vectors of their own. Null key: never linked, ``component_id`` null, kept. An empty table
    gives no rows. Other columns are ignored.

    Equal vectors of a label are one class with a weight, so a group of copies is compared once.
    A cell is compared in blocks of bounded size whatever its share of the rows.
    """
    kind = vectors.select(embedding).schema[0].dataType.simpleString()  # floats stay floats, all else is compared as doubles
    v = vectors.select(F.col(key).cast("long").alias("key"), F.col(label).cast("string").alias("label"),
                       F.col(embedding).cast(kind if kind == "array<float>" else "array<double>").alias("embedding"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    good = F.coalesce(F.col("key").isNotNull() & F.col("label").isNotNull() & ~bad & some, F.lit(False))
    v = v.withColumn("good", good)
    real = v.where("good").drop("good")
    classes = stored(real.groupBy("label", "embedding").agg(F.count("*").alias("weight"), F.min("key").alias("first"))
                     .withColumns({"id": F.monotonically_increasing_id(), "dim": F.size("embedding")}), "classes")
    found = stored(links(classes.drop("first"), cosine), "links")
    comp = components(found, "id", "root")
    n = found.groupBy("id").agg((F.sum("linked") - 1).alias("n_links"))
    roots = (classes.select("id", "label", "embedding", "first").join(n, "id")
             .join(comp, F.col("id") == F.col("node"), "left").withColumn("root", F.coalesce("root", "id")))
    roots = stored(roots.select("root", "label", "embedding", "first", "n_links"), "roots")
    least = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    roots = roots.join(least, "root").drop("root", "first")
    out = (real.join(roots, ["label", "embedding"]).select("key", "n_links", "component_id")
           .union(v.where("NOT good").select("key", F.lit(0).cast("long").alias("n_links"), F.col("key").alias("component_id"))))
    return out.select(F.col("key").alias(key), "n_links", "component_id",
                      F.coalesce(F.col("component_id") == F.col("key"), F.lit(True)).alias("kept"))
