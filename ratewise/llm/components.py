"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _hang(edges: DataFrame) -> DataFrame:
    """(u, v) -> every v of u's neighbours joined to the smallest of them (``m``)."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return edges.join(least, "u")


def components(links: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node that has a link; root is the smallest node reachable.

    Each round is two partial aggregates (minimum per node) and two joins; it replaces a path by
    stars, so the number of rounds is logarithmic in the longest path. Every round is written to
    the shared scratch folder, so the lineage does not grow. Self links are ignored; nulls must not
    occur. ``max_rounds`` only guards against a defect: reaching it raises.
    """
    edges = (links.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v"))
             .where("u <> v").distinct())
    edges = stored(edges, "edges")
    before = None
    for _ in range(max_rounds):
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _hang(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()  # u > v: each node points at a smaller one
        low = _hang(large)
        small = (low.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        edges = stored(small, "edges")
        now = edges.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = now
    raise RuntimeError("components did not converge")


def local_roots(near: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For nodes ``a`` (rows) and ``b`` (columns) of one block and their link matrix: the smallest
    node of each one's linked set within the block. A block thus hands on a star for each set
    instead of all its links."""
    most = np.iinfo(np.int64).max
    la, lb = a.copy(), b.copy()
    while True:
        new_a = np.minimum(la, np.where(near, lb, most).min(axis=1))
        new_b = np.minimum(lb, np.where(near, new_a[:, None], most).min(axis=0))
        if (new_a == la).all() and (new_b == lb).all():
            return la, lb
        la, lb = new_a, new_b
