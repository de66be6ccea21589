"""MinHash near-dedup with an LSH forest.

Each distinct shingle set gets one signature per tree, a short sequence of min-hashes. Sorting the
documents by a tree's signature puts documents with a long common prefix beside each other; a run
with the same prefix is a region. Regions start at depth ``DEPTHS[0]``; where a region holds many
documents the depth grows, so that its documents meet their closest neighbours first; where a document
has no neighbour at that depth in any tree, the depth falls to ``SHALLOW`` for it, and it meets those
beside it in the sorted orders, with which its common prefixes are the longest.

The work is linear in the documents even inside a group of thousands of near copies:

1. equal sets are one class, represented by the smallest document;
2. in each region every class is paired with the region's smallest class (a star), at each depth
   the region reaches; the pairs are confirmed on full sets and joined to components;
3. pairs of one region that are still in different components are compared exhaustively: in small
   regions as rows, whose likely pairs are confirmed on full sets; in large ones as blocks of full
   sets, each of which hands on a star for every linked set and not all its links;
4. a class that is alone at depth 4 in all trees is paired with its neighbours in the sorted orders of
   the trees, down to a common prefix of ``SHALLOW``.

Step 3 leaves no pair of a region out, so a link is lost only if its documents share no region of
depth 4 in any tree - (1 - 0.8**4)**16 = 0.02 % at similarity 0.8, 0.0008 % at 0.85 - and step 4 does
not bring them together: one of them has another neighbour at depth 4, or others lie between them in
all the trees.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

from .common import map_frames, numbered, ship, stored
from .components import components, local_roots

TREES = 16
#: Region depths in min-hashes; the last is the length of a tree's signature.
DEPTHS = (4, 6, 8)
#: Depth for classes without a neighbour at ``DEPTHS[0]`` in any tree.
SHALLOW = 2
#: A region with more classes than this goes deeper, and is compared in blocks.
LARGE = 32
#: Classes in a block.
BLOCK = 256
WORDS = 4
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 80
#: A pair whose share of equal min-hashes (of 128) is under this is not confirmed on full sets; a
#: link has less with a probability of 1e-9 (0.8 - 0.6 is 5.7 standard deviations).
LIKELY = 0.6

_FUNCS = TREES * DEPTHS[-1]
_RNG = np.random.Generator(np.random.PCG64(20240229))
_XOR = _RNG.integers(0, 2**32, _FUNCS, dtype=np.uint32)[:, None]
_MUL = (_RNG.integers(0, 2**32, _FUNCS, dtype=np.uint32) | np.uint32(1))[:, None]
_P = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(0xD6E8FEB86659FD93)

_WORD_HASH: dict[bytes, int] = {}
_WORD_HASH_MOST = 150_000


def _word_hashes(words: list[bytes]) -> np.ndarray:
    memo = _WORD_HASH
    if len(memo) > _WORD_HASH_MOST:
        memo.clear()
    out = []
    for w in words:
        h = memo.get(w)
        if h is None:
            h = memo[w] = xxhash.xxh3_64_intdigest(w)
        out.append(h)
    return np.array(out, np.uint64)


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles (A-Z lower-cased, words between ASCII
    blanks); of the whole sequence if there are fewer words; empty without words."""
    w = _word_hashes((text or "").encode("utf-8", "surrogatepass").lower().split())
    n = min(len(w), words)
    if n == 0:
        return np.empty(0, np.uint64)
    h = np.full(len(w) - n + 1, n, np.uint64)
    for i in range(n):
        h = (h ^ w[i:len(w) - n + 1 + i]) * _P
        h ^= h >> np.uint64(29)
    h *= _Q
    return np.unique(h ^ (h >> np.uint64(32)))


def signature(shingles: np.ndarray) -> bytes:
    """Min-hashes of all trees as little-endian unsigned 32-bit numbers."""
    low = None
    small = (shingles >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(small), 1024):
        got = ((small[None, i:i + 1024] ^ _XOR) * _MUL).min(axis=1)
        low = got if low is None else np.minimum(low, got)
    return b"" if low is None else low.astype("<u4").tobytes()


def _sign(words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            n, key, sig = [], [], []
            for text in b["text"]:
                s = shingle_set(text, words)
                n.append(len(s))
                key.append(xxhash.xxh3_128_hexdigest(s.tobytes()) if len(s) else None)
                sig.append(signature(s))
            yield pd.DataFrame({"doc": b["doc"], "n": n, "set_key": key, "sig": sig})
    return run


def signatures(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc, text) -> (doc, n, set_key, sig)."""
    ship(docs.sparkSession)
    return map_frames(docs, _sign(words), "doc long, n long, set_key string, sig binary")


def regions(classes: DataFrame, members: DataFrame | None, level: int) -> DataFrame:
    """(region, id, tree, n_in, first): regions at ``DEPTHS[level]`` with two or more classes; of the
    classes and trees in ``members`` (the large regions one level up), or of all."""
    width, depth = 4 * DEPTHS[-1], 4 * DEPTHS[level]
    if members is None:
        rows = classes.select("id", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"), "sig")
    else:
        rows = members.select("id", "tree").join(classes.select("id", "sig"), "id")
    rows = rows.select("id", "tree", F.xxhash64("tree", F.expr(f"substring(sig, tree * {width} + 1, {depth})")).alias("region"))
    size = (rows.groupBy("region").agg(F.count("*").alias("n_in"), F.min("id").alias("first"))
            .where("n_in > 1"))
    return stored(rows.join(size, "region"), f"regions{level}")


def lonely_pairs(classes: DataFrame, deep: DataFrame) -> DataFrame:
    """Pairs (a, b) for classes that share no region of depth ``DEPTHS[0]`` (``deep``) with another class:
    their neighbours in each tree's sorted signatures, where the longest common prefixes are, if these
    are ``SHALLOW`` min-hashes or more. At most two a tree and class, so the work stays linear.

    Only runs of equal shallow prefixes that hold a lonely class are sorted. They are numbered in order,
    and rows meet the next number, so a run of any size is spread over many tasks."""
    alone = stored(classes.join(deep.select("id").distinct(), "id", "left_anti").select("id", F.lit(True).alias("alone")), "alone")
    width, depth = 4 * DEPTHS[-1], 4 * SHALLOW
    part = lambda t, lo, n: F.substring("sig", t * width + 1 + lo, n)
    trees = F.array(*[F.struct(F.xxhash64(F.lit(t), part(t, 0, depth)).alias("region"), part(t, depth, width - depth).alias("rest"))
                      for t in range(TREES)])
    rows = (classes.select("id", trees.alias("trees")).join(alone, "id", "left")
            .select("id", F.col("alone").isNotNull().alias("alone"), F.inline("trees")))
    some = rows.groupBy("region").agg(F.count("*").alias("n"), F.bool_or("alone").alias("any")).where("n > 1 AND any").select("region")
    order = stored(numbered(rows.join(some, "region"), "region", ["rest", "id"], "place").select("region", "place", "id", "alone"), "order")
    after = order.select("region", (F.col("place") - 1).alias("place"), F.col("id").alias("next"), F.col("alone").alias("next_alone"))
    pairs = order.join(after, ["region", "place"]).where("alone OR next_alone")
    return pairs.select(F.least("id", "next").alias("a"), F.greatest("id", "next").alias("b")).distinct()


@pandas_udf(DoubleType())
def _likeness(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([np.mean(np.frombuffer(x, "<u4") == np.frombuffer(y, "<u4")) for x, y in zip(a, b)], dtype="float64")


def _likely(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (a, b) of comparable set sizes whose signatures look alike."""
    one = pairs.join(classes.select(F.col("id").alias("a"), F.col("sig").alias("sa"), F.col("n").alias("na")), "a")
    two = one.join(classes.select(F.col("id").alias("b"), F.col("sig").alias("sb"), F.col("n").alias("nb")), "b")
    # an intersection is at most the smaller set, a union at least the larger
    return (two.where(100 * F.least("na", "nb") >= PERCENT * F.greatest("na", "nb"))
            .where(_likeness("sa", "sb") >= LIKELY).select("a", "b"))


def _sets(words: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sets = [shingle_set(t, words) for t in b["text"]]
            yield pd.DataFrame({"doc": b["doc"], "set_key": [xxhash.xxh3_128_hexdigest(s.tobytes()) for s in sets],
                                "set": [s.view(np.int64) for s in sets]})
    return run


def class_sets(ids: DataFrame, named: DataFrame, reps: DataFrame, words: int) -> DataFrame:
    """(id, set) of the classes ``ids``. Only the texts that represent one of them are read again."""
    need = reps.join(ids.distinct(), "id", "left_semi")
    texts = named.join(need.select("doc"), "doc", "left_semi").dropDuplicates(["doc", "text"])
    return stored(map_frames(texts, _sets(words), "doc long, set_key string, set array<long>")
                  .join(need, ["set_key", "doc"]).select("id", "set"), "sets")


def confirmed(pairs: DataFrame, named: DataFrame, reps: DataFrame, words: int) -> DataFrame:
    """The pairs (a, b) of classes that are links on their full shingle sets."""
    pairs = stored(pairs, "pairs")
    sets = class_sets(pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))), named, reps, words)
    one = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("sa")), "a")
    two = one.join(sets.select(F.col("id").alias("b"), F.col("set").alias("sb")), "b")
    both = F.size(F.array_intersect("sa", "sb"))
    link = 100 * both >= PERCENT * (F.size("sa") + F.size("sb") - both)
    return two.where(link).select("a", "b")


def _small_cross(region: DataFrame, comp: DataFrame) -> DataFrame:
    """All pairs of small regions that are in different components."""
    rows = region.where(F.col("n_in") <= LARGE).select("region", "id").join(comp, "id", "left")
    rows = rows.withColumn("root", F.coalesce("root", "id"))
    # regions that are one component already, the usual case, go before the pairs are made
    open_ = rows.groupBy("region").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1").select("region")
    rows = rows.join(open_, "region")
    other = rows.select("region", F.col("id").alias("b"), F.col("root").alias("root_b"))
    return (rows.withColumnRenamed("id", "a").join(other, "region")
            .where("a < b AND root <> root_b").select("a", "b"))


def overlaps(left: list[np.ndarray], right: list[np.ndarray] | None, width: int = 4096) -> np.ndarray:
    """Sizes of the intersections of all left with all right sets (of the left ones among themselves
    without right), as products of 0/1 matrices of ``width`` shingles each."""
    sets = left + (right or [])
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1  # a shingle of one set alone is in no intersection
    number = np.cumsum(shared) - 1
    owner, column = owner[shared[column]], number[column[shared[column]]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    n = len(left)
    out = np.zeros((n, len(right) if right is not None else n))
    for lo in range(0, int(shared.sum()), width):
        i, j = np.searchsorted(column, [lo, lo + width])
        m = np.zeros((len(sets), width), np.float32)
        m[owner[i:j], column[i:j] - lo] = 1
        out += m[:n] @ (m[n:] if right is not None else m).T
    return out


def _link_blocks(group: pd.DataFrame) -> pd.DataFrame:
    """Links of one block, or of one block with another, on full sets: each class with the smallest
    of those it is linked to, directly or through others of the block."""
    left, right = group[group["side"] == 0], group[group["side"] == 1]
    a = left["id"].to_numpy()
    ls = [np.asarray(s, np.int64) for s in left["set"]]
    b, rs = (right["id"].to_numpy(), [np.asarray(s, np.int64) for s in right["set"]]) if len(right) else (a, None)
    if not len(a):
        return pd.DataFrame({"a": [], "b": []}, dtype="int64")
    both = overlaps(ls, rs)
    na, nb = np.array([len(s) for s in ls]), np.array([len(s) for s in (ls if rs is None else rs)])
    la, lb = local_roots(100 * both >= PERCENT * (na[:, None] + nb[None, :] - both), a, b)
    ids, roots = (a, la) if rs is None else (np.concatenate([a, b]), np.concatenate([la, lb]))
    return pd.DataFrame({"a": roots[roots != ids], "b": ids[roots != ids]})


def _large_cross(region: DataFrame, comp: DataFrame, named: DataFrame, reps: DataFrame, words: int) -> DataFrame:
    """Links of large regions between different components, on full sets.

    A region's classes are dealt to blocks of about ``BLOCK``: those of a component of that size
    by themselves, the others together. Two blocks meet in one group unless both are of one
    component; a group holds two blocks, however large the region.
    """
    rows = region.where(F.col("n_in") > LARGE).select("region", "id").join(comp, "id", "left")
    rows = rows.withColumn("root", F.coalesce("root", "id"))
    parts = rows.groupBy("region", "root").agg(F.count("*").alias("n"))
    parts = parts.withColumn("own", F.when(F.col("n") >= BLOCK, F.col("root")))
    sizes = parts.groupBy("region", "own").agg(F.sum("n").alias("n"), F.count("*").alias("roots"))
    several = sizes.groupBy("region").agg(F.sum("roots").alias("k")).where("k > 1").select("region")
    sizes = stored(sizes.join(several, "region").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int")), "sizes")
    rows = (rows.join(parts.select("region", "root", "own"), ["region", "root"])
            .join(sizes.select("region", F.col("own").alias("o"), "blocks"), "region")
            .where(F.col("own").eqNullSafe(F.col("o"))))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).select("region", "id", "root", "own", "block")
    block = sizes.select("region", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    other = block.select("region", F.col("own").alias("own2"), F.col("block").alias("block2"))
    order = F.struct(F.coalesce("own", F.lit(-1)), "block")
    order2 = F.struct(F.coalesce("own2", F.lit(-1)), "block2")
    meets = block.join(other, "region").where(order <= order2).where(
        ~(F.col("own").isNotNull() & F.col("own").eqNullSafe(F.col("own2"))))
    meets = stored(meets.withColumn("meet", F.monotonically_increasing_id()), "meets")
    first = meets.select("meet", "region", "own", "block", F.lit(0).alias("side"))
    second = (meets.where(~(F.col("own").eqNullSafe(F.col("own2")) & (F.col("block") == F.col("block2"))))
              .select("meet", "region", F.col("own2").alias("own"), F.col("block2").alias("block"), F.lit(1).alias("side")))
    sides = first.union(second).select("meet", "side", F.col("region").alias("rg"), F.col("own").alias("ow"), F.col("block").alias("bl"))
    dealt = rows.join(sides, (F.col("region") == F.col("rg")) & (F.col("block") == F.col("bl")) & F.col("own").eqNullSafe(F.col("ow")))
    dealt = stored(dealt.select("meet", "side", "id"), "dealt")
    sets = class_sets(dealt.select("id"), named, reps, words)
    return dealt.join(sets, "id").groupBy("meet").applyInPandas(_link_blocks, "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``.

    Null, empty or blank text: 0 shingles, linked with nothing, kept. Rows that repeat a key are
    one document: they share their component, and each is kept if the key is the component's
    smallest. Null key: never linked, ``component_id`` null, kept. An empty table gives no rows.
    Other columns are ignored.
    """
    named = docs.select(F.col(key).cast("long").alias("doc"), F.col(text).alias("text"))
    signed = stored(signatures(named, words), "signed")
    real = signed.where("doc IS NOT NULL AND n > 0")
    # a class for each distinct set, represented by its smallest document
    reps = stored(real.groupBy("set_key").agg(F.min("doc").alias("doc"))
                  .withColumn("id", F.monotonically_increasing_id()), "reps")
    classes = stored(real.join(reps, ["set_key", "doc"]).select("id", "n", "sig").dropDuplicates(["id"]), "classes")

    levels, members = [], None
    for level in range(len(DEPTHS)):
        got = regions(classes, members, level)
        levels.append(got)
        members = got.where(F.col("n_in") > LARGE)
    stars = levels[0]
    for more in levels[1:]:
        stars = stars.union(more)
    stars = stars.where("first <> id").select(F.col("first").alias("a"), F.col("id").alias("b")).distinct()
    links = stored(confirmed(_likely(stars, classes), named, reps, words), "links")
    comp = components(links, "a", "b").select(F.col("node").alias("id"), "root")

    rest = _likely(_small_cross(levels[0], comp).union(lonely_pairs(classes, levels[0])).distinct(), classes)
    links = (links.union(confirmed(rest, named, reps, words))
             .union(_large_cross(levels[0], comp, named, reps, words)))
    # rows that repeat a key with other texts are one document: the key links their classes
    of_doc = real.join(reps.select("set_key", "id"), "set_key").select("doc", "id").distinct()
    split = (of_doc.groupBy("doc").agg(F.min("id").alias("a"), F.count("*").alias("k")).where("k > 1")
             .join(of_doc, "doc").select("a", F.col("id").alias("b")))
    comp = components(links.union(split), "a", "b")

    root = reps.join(comp, reps["id"] == comp["node"], "left").select("set_key", "doc", F.coalesce("root", "id").alias("root"))
    least = root.groupBy("root").agg(F.min("doc").alias("component_id"))
    found = root.join(least, "root").select("set_key", "component_id")
    alone = signed.where("doc IS NULL OR n = 0").select("doc", "n", F.col("doc").alias("component_id"))
    out = real.join(found, "set_key").select("doc", "n", "component_id").union(alone)
    return out.select(F.col("doc").alias(key), F.col("n").alias("n_shingles"), "component_id",
                      F.coalesce(F.col("component_id") == F.col("doc"), F.lit(True)).alias("kept"))
