"""Sharding by longest-processing-time scheduling.

Rows of equal text form a group that must stay in one shard. Groups are taken from the largest to
the smallest, and each goes to the shard with the least bytes so far, kept in a heap. The heap sees
every large group by itself; the rest come in classes of (nearly) equal size, and as many groups of
a class as keep the least-loaded shards least loaded are dealt at once, which is what the heap would
do one by one. So the schedule is made on a table whose size does not depend on the corpus, and
groups find their shard by their number in the class.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import numbered, stored

SHARDS = 16
LAW = "bytes"
#: Groups above total / (shards * SINGLE) bytes are scheduled one by one: fewer than shards * SINGLE.
SINGLE = 500
#: Below this a class is one exact size; above, sizes that agree in their leading 9 bits
#: (0.4 % apart): fewer than 15,000 classes for any corpus.
EXACT = 1 << 9
#: Groups with more than 1 / HOT of all rows, fewer than HOT, reach their rows by broadcast.
HOT = 1000


def schedule(classes: pd.DataFrame, shards: int) -> pd.DataFrame:
    """``classes`` (class, size, n: number of groups of this size), any order -> (class, shard,
    first, last): the groups numbered ``first`` to ``last`` - 1 of the class go to ``shard``.

    Ties go to the lowest shard number."""
    heap = [(0.0, s) for s in range(shards)]
    out = []
    for c in classes.sort_values(["size", "class"], ascending=[False, True]).itertuples(index=False):
        dealt = dict.fromkeys(range(shards), 0)
        left = int(c.n)
        if left > 2 * shards:
            # all shards rise to the water level that nearly uses the class up; the heap deals the rest
            loads = sorted(heap)
            below, level = 0.0, 0.0
            for k, (load, _) in enumerate(loads, 1):
                below += load
                level = (below + left * c.size) / k
                if k == shards or level <= loads[k][0]:
                    break
            heap = []
            for load, s in loads:
                whole = min(left, max(0, int((level - load) // c.size) - 1))
                dealt[s] += whole
                left -= whole
                heap.append((load + whole * c.size, s))
            heapq.heapify(heap)
        for _ in range(left):
            load, s = heap[0]
            heapq.heapreplace(heap, (load + c.size, s))
            dealt[s] += 1
        first = 0
        for s, k in dealt.items():
            if k:
                out.append((c[0], s, first, first + k))
                first += k
    return pd.DataFrame(out, columns=["class", "shard", "first", "last"])


def size_class(size: Column) -> Column:
    """The size itself below ``EXACT``, else its leading 9 bits with zeros after them; negated, so
    that single groups, which have numbers from 0 up, never meet it."""
    unit = F.pow(F.lit(2.0), F.greatest(F.length(F.bin(size)) - 9, F.lit(0))).cast("long")
    return -(size - size % unit)


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, size, crc, digest, row), stored: the texts are read once, in place."""
    body = F.coalesce(F.col(text), F.lit(""))
    return stored(docs.select(
        F.col(key).alias("doc"), (F.octet_length(body) + F.lit(1)).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("crc"),
        F.unhex(F.sha2(body, 256)).alias("digest"), F.monotonically_increasing_id().alias("row")), "measured")


def assign(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(digest, n, shard), stored: the shard of every group of ``rows`` (size, digest)."""
    spark = rows.sparkSession
    groups = stored(rows.groupBy("digest").agg(F.sum("size").alias("bytes"), F.count("*").alias("n")), "groups")
    total = groups.agg(F.sum("bytes").alias("b")).first()["b"] or 0
    least = total // (shards * SINGLE)
    large = groups.where(F.col("bytes") > least).withColumn("class", F.lit(0).cast("long"))
    small = groups.where(F.col("bytes") <= least).withColumn("class", size_class(F.col("bytes")))
    # number 0 of a class is its largest group; each large group is a class of its own, by number
    ranked = stored(numbered(large.unionByName(small).withColumn("down", -F.col("bytes")), "class", ["down", "digest"], "number"), "ranked")
    single = F.col("class") == 0
    classes = (ranked.groupBy(F.when(single, F.col("number")).otherwise(F.col("class")).alias("class"))
               .agg(F.avg("bytes").alias("size"), F.count("*").alias("n")).toPandas())
    plan = schedule(classes, shards)
    if plan.empty:
        return ranked.select("digest", "n", F.lit(0).alias("shard"))
    plan = spark.createDataFrame(plan, "class long, shard int, first long, last long")
    ends = plan.groupBy("class").agg(F.sort_array(F.collect_list(F.struct("last", "shard"))).alias("ends"))
    ranked = (ranked.withColumn("place", F.when(single, F.lit(0)).otherwise(F.col("number")))
              .withColumn("class", F.when(single, F.col("number")).otherwise(F.col("class"))))
    at = F.filter("ends", lambda e: e["last"] > F.col("place"))[0]["shard"]
    return stored(ranked.join(ends, "class").select("digest", "n", at.alias("shard")), "assigned")


def shard(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard), one row per row of ``docs``.

    ``size`` is the text's UTF-8 bytes plus 1. Null text counts as empty text and shares its group.
    Slots of a shard ascend by key (null first), rows that repeat a key by their digest. An empty
    table gives no rows. Other columns are ignored. The law is ``bytes``: the largest shard exceeds
    the mean by at most the size of one small group, unless one group alone is larger than a shard;
    ``grown_shard`` is null.

    What is shuffled is one narrow row per document. A text that many rows share is summed before
    the shuffle, and reaches its rows by a broadcast of fewer than ``HOT`` rows.
    """
    rows = measured(docs, key, text)
    groups = assign(rows, shards)
    total = rows.agg(F.count("*").alias("n")).first()["n"]
    hot = stored(groups.where(F.col("n") * HOT > total).select("digest", "shard"), "hot")  # fewer than HOT rows
    here = rows.join(F.broadcast(hot), "digest")
    rest = (rows.join(F.broadcast(hot), "digest", "left_anti")
            .join(groups.where(F.col("n") * HOT <= total).select("digest", "shard"), "digest"))
    placed = stored(here.unionByName(rest).select("doc", "size", "crc", "digest", "row", "shard"), "sharded")
    return numbered(placed, "shard", ["doc", "digest", "row"], "slot").select(
        F.col("doc").alias(key), "size", F.col("crc").alias("text_crc32"), F.lit(LAW).alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))
