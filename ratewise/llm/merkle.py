"""Merkle manifest of a dataset in van Emde Boas layout.

Every document is a leaf; the leaves of one language form a tree, the roots of these trees form
another, whose root stands for the dataset. A tree is cut into aligned blocks of ``HEIGHT`` levels.
A block is one row: its digests in one byte string, laid out by splitting the subtree at half its
height, again and again, top half first, then each bottom subtree. The address of a node is
arithmetic on (levels, depth, index), so construction and the look-up of siblings need no pointers
and touch few cache lines whatever the line size. The roots of a level's blocks are the leaves of
the next level's, until one root is left; a proof is read from the blocks on the way down.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import numbered, ship, stored

#: Levels of edges in a block: it has at most 2 ** HEIGHT leaves.
HEIGHT = 8
SIZE = 32
NONE, LEFT, RIGHT = b"0", b"1", b"2"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def H(data: bytes) -> bytes:
    return hashlib.sha256(data).digest()


def addresses(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Places of the nodes ``index`` (from the left) at ``depth`` in a complete binary tree of
    ``levels`` levels: the top half of the levels comes first, as a tree of its own, then each of
    the bottom subtrees in turn; both are laid out in the same way."""
    if levels == 1:
        return np.zeros(len(index), np.int64)
    top = levels // 2
    if depth < top:
        return addresses(top, depth, index)
    below = depth - top
    subtree = index >> below
    inside = addresses(levels - top, below, index & ((1 << below) - 1))
    return (1 << top) - 1 + subtree * ((1 << (levels - top)) - 1) + inside


@lru_cache(maxsize=None)
def layout(height: int) -> list[np.ndarray]:
    """For each depth 0 to ``height``: the byte offsets of that depth's nodes."""
    return [addresses(height + 1, d, np.arange(1 << d)) * SIZE for d in range(height + 1)]


def build(leaves: list[bytes], height: int) -> bytes:
    """The block over ``leaves`` (1 to 2 ** height of them). A run of one node is hashed alone;
    places without a node stay zero."""
    where = layout(height)
    out = bytearray(SIZE * ((2 << height) - 1))
    level = leaves
    for depth in range(height, -1, -1):
        at = where[depth].tolist()
        for i, node in enumerate(level):
            out[at[i]:at[i] + SIZE] = node
        if depth:
            text = [x.hex() for x in level]
            level = [H("".join(text[i:i + 2]).encode()) for i in range(0, len(text), 2)]
    return bytes(out)


def path(nodes: bytes, height: int, n: int, index: int) -> bytes:
    """The way from leaf ``index`` of a block with ``n`` leaves to its root: per level the side of
    the sibling and the sibling in hex, or ``NONE``."""
    where, out = layout(height), []
    for depth in range(height, 0, -1):
        other = index ^ 1
        if other < n:
            at = int(where[depth][other])
            out.append((LEFT if other < index else RIGHT) + nodes[at:at + SIZE].hex().encode())
        else:
            out.append(NONE)
        index >>= 1
        n = (n + 1) >> 1
    return b"".join(out)


def steps(way: bytes) -> Iterator[tuple[bytes, bytes]]:
    i = 0
    while i < len(way):
        side = way[i:i + 1]
        i += 1
        sibling = b"" if side == NONE else way[i:i + 2 * SIZE]
        i += len(sibling)
        yield side, sibling


def fold(leaf: bytes, way: bytes) -> bytes:
    """The root that a leaf (hex) and the siblings on its way lead to."""
    node = leaf
    for side, sibling in steps(way):
        node = hashlib.sha256(sibling + node if side == LEFT else node + sibling).hexdigest().encode()
    return node


def siblings_hash(way: bytes) -> str:
    return hashlib.sha256(b"".join(s for _, s in steps(way))).hexdigest()


def _written(c: Column) -> Column:
    value = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_hash(columns: dict[str, Column]) -> Column:
    """Raw digest of a row: each field is ``-`` if null, else its byte count, ``:`` and its value."""
    return F.unhex(F.sha2(F.concat(*[_written(columns[f]) for f in FIELDS]), 256))


def leaves(docs: DataFrame) -> DataFrame:
    """(tree, doc, leaf, tampered, row), stored: one row per document. ``tampered`` is the leaf after
    1 was added to n_chars, null where nothing is tampered with (or n_chars is null)."""
    c = {f: F.col(f) for f in FIELDS}
    marked = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 0
    changed = F.when(marked & F.col("n_chars").isNotNull(), leaf_hash(c | {"n_chars": F.col("n_chars") + 1}))
    # null first, then bytewise: no language is a string of its own before all others
    tree = F.coalesce(F.concat(F.lit("="), "lang"), F.lit(""))
    return stored(docs.select(tree.alias("tree"), F.col("doc_id").alias("doc"), leaf_hash(c).alias("leaf"),
                              changed.alias("tampered"), F.monotonically_increasing_id().alias("row")), "leaves")


def _height(n: Column, most: int) -> Column:
    """Levels above n nodes until one is left, at most ``most``."""
    need = F.length(F.bin(n - 1))
    return F.when(n <= 1, 0).otherwise(F.least(need, F.lit(most))).cast("int")


_BLOCK = pa.schema([("tree", pa.string()), ("block", pa.int64()), ("height", pa.int32()), ("n", pa.int32()),
                    ("root", pa.binary()), ("nodes", pa.binary()), ("docs", pa.list_(pa.int64())), ("tampered", pa.list_(pa.binary()))])
_BLOCK_DDL = "tree string, block long, height int, n int, root binary, nodes binary, docs array<long>, tampered array<binary>"


def _rows(b: pa.RecordBatch) -> Iterator[dict]:
    """One block at a time, as a batch may hold thousands of them: at most 2 ** HEIGHT leaves."""
    for i in range(b.num_rows):
        yield {name: column[i].as_py() for name, column in zip(b.schema.names, b.columns)}


def _build_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for row in _rows(b):
            members = row["members"]
            nodes = build([m["node"] for m in members], row["height"])
            yield pa.RecordBatch.from_pylist([{
                "tree": row["tree"], "block": row["block"], "height": row["height"], "n": len(members), "root": nodes[:SIZE],
                "nodes": nodes, "docs": [m["doc"] for m in members], "tampered": [m["tampered"] for m in members]}], _BLOCK)


def _blocks(nodes: DataFrame, sizes: DataFrame, height: int) -> DataFrame:
    """Stored blocks over ``nodes`` (tree, pos, node, doc, tampered) of trees with ``n`` nodes."""
    member = F.struct("pos", "node", "doc", "tampered")
    groups = (nodes.groupBy("tree", F.shiftright("pos", height).alias("block"))
              .agg(F.sort_array(F.collect_list(member)).alias("members"))
              .join(sizes.select("tree", _height(F.col("n"), height).alias("height")), "tree"))
    return stored(groups.select("tree", "block", "height", "members").mapInArrow(_build_blocks, _BLOCK_DDL), "blocks")


def tower(nodes: DataFrame, height: int = HEIGHT) -> list[DataFrame]:
    """Block tables from the leaves up, each over the roots of the one before, until every tree has
    one root: log2(leaves) / height rounds."""
    nodes = nodes.select("tree", "pos", "node", "doc", "tampered")
    sizes = stored(nodes.groupBy("tree").agg((F.max("pos") + 1).alias("n")), "sizes")
    most = sizes.agg(F.max("n").alias("n")).first()["n"] or 0
    out = []
    while most:
        blocks = _blocks(nodes, sizes, height)
        out.append(blocks)
        if most <= 1 << height:
            break
        nodes = blocks.select("tree", F.col("block").alias("pos"), F.col("root").alias("node"),
                              F.lit(None).cast("long").alias("doc"), F.lit(None).cast("binary").alias("tampered"))
        up = F.shiftright(F.col("n") + ((1 << height) - 1), height)
        sizes, most = sizes.select("tree", up.alias("n")), (most + (1 << height) - 1) >> height
    return out


def _child_ways(height: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("tree", pa.string()), ("pos", pa.int64()), ("node", pa.binary()), ("way", pa.binary())])
        for b in batches:
            for row in _rows(b):
                at = layout(row["height"])[-1].tolist()
                yield pa.RecordBatch.from_pylist([
                    {"tree": row["tree"], "pos": (row["block"] << height) + i, "node": row["nodes"][at[i]:at[i] + SIZE],
                     "way": path(row["nodes"], row["height"], row["n"], i) + row["above"]} for i in range(row["n"])], schema)
    return run


def descend(levels: list[DataFrame], above: DataFrame, height: int = HEIGHT) -> DataFrame:
    """(tree, pos, way) for the leaves of a tower whose roots have the ways ``above`` (tree, pos, way)."""
    for blocks in reversed(levels):
        joined = blocks.join(above.select("tree", F.col("pos").alias("block"), F.col("way").alias("above")), ["tree", "block"])
        # stored: a task never has more than one of these Python steps
        above = stored(joined.select("tree", "block", "height", "n", "nodes", "above").mapInArrow(
            _child_ways(height), "tree string, pos long, node binary, way binary"), "ways")
    return above


def _proofs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("root", pa.string()),
                        ("proof_sha256", pa.string()), ("folded_root", pa.string()), ("verified", pa.bool_())])
    for b in batches:
        for row in _rows(b):
            at, subroot, root = layout(row["height"])[-1].tolist(), row["subroot"].hex(), row["root"].hex()
            out = []
            for i, (doc, other) in enumerate(zip(row["docs"], row["tampered"])):
                leaf = row["nodes"][at[i]:at[i] + SIZE]
                way = path(row["nodes"], row["height"], row["n"], i) + row["above"]
                folded = fold((other or leaf).hex().encode(), way).decode()
                out.append({"doc_id": doc, "leaf": leaf.hex(), "subroot": subroot, "root": root,
                            "proof_sha256": siblings_hash(way), "folded_root": folded, "verified": folded == root})
            yield pa.RecordBatch.from_pylist(out, schema)


def manifest(docs: DataFrame, height: int = HEIGHT) -> tuple[list[DataFrame], list[DataFrame]]:
    """The stored block tables of the languages' trees and of the tree of their roots."""
    ship(docs.sparkSession)
    found = numbered(leaves(docs), "tree", ["doc", "leaf", "row"], "pos")
    trees = tower(found.withColumnRenamed("leaf", "node"), height)
    if not trees:
        return [], []
    roots = trees[-1].select(F.lit("").alias("all"), "tree", "root")
    ranked = numbered(roots, "all", ["tree"], "pos")
    tops = stored(ranked, "subroots")
    return trees, [tops, *tower(tops.select(F.lit("").alias("tree"), "pos", F.col("root").alias("node"),
                                            F.lit(None).cast("long").alias("doc"), F.lit(None).cast("binary").alias("tampered")), height)]


RESULT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def verify(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified), one row per row of ``docs``
    (doc_id, source, lang, n_chars, text).

    Leaves of a language (null is one) ascend by doc_id, null first; rows that repeat a doc_id by
    their digest. Null doc_id, n_chars, source, lang or text are written ``-``; a null doc_id is never
    tampered with. An empty table gives no rows. Other columns are ignored.

    The texts are hashed where they are read; what is shuffled is one narrow row per document, then
    one row per block. A language with most of the rows is spread over tasks by doc_id.
    """
    trees, top = manifest(docs, height)
    if not trees:
        return docs.sparkSession.createDataFrame([], RESULT)
    subroots, tops = top[0], top[1:]
    start = tops[-1].select("tree", F.col("block").alias("pos"), F.lit(b"").alias("way"))
    root = tops[-1].select(F.col("root").alias("apex"))  # one block, one row
    ways = (descend(tops, start, height).join(subroots.select(F.col("tree").alias("lang_tree"), "pos"), "pos")
            .select(F.col("lang_tree").alias("tree"), F.col("node").alias("subroot"), F.lit(0).cast("long").alias("pos"), "way"))
    ways = stored(ways.crossJoin(F.broadcast(root)), "ways")
    above = descend(trees[1:], ways.select("tree", "pos", "way"), height)
    joined = (trees[0].join(above.select("tree", F.col("pos").alias("block"), F.col("way").alias("above")), ["tree", "block"])
              .join(ways.select("tree", "subroot", F.col("apex").alias("root_")), "tree"))
    return joined.select("height", "n", "nodes", "docs", "tampered", "above", "subroot", F.col("root_").alias("root")).mapInArrow(_proofs, RESULT)


def oracle() -> str:
    """The same in SQL: levels by a recursive query, then the proofs folded level by level."""
    def written(c):
        return f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"

    plain = " || ".join(written(f) for f in FIELDS)
    changed = " || ".join(written("n_chars + 1" if f == "n_chars" else f) for f in FIELDS)
    digits = "list_transform(range(strlen(CAST(doc_id AS VARCHAR))), lambda i: CAST(ascii(substr(CAST(doc_id AS VARCHAR), i + 1, 1)) AS BIGINT))"
    bits = "list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    crc = f"xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {digits}), lambda c, b: {bits}))"
    return f"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, coalesce('=' || lang, '') AS tree, sha256({plain}) AS leaf,
         CASE WHEN {crc} % 7 = 0 THEN sha256({changed}) ELSE sha256({plain}) END AS start FROM documents),
l AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n FROM d),
t(tree, level, pos, h, n) AS (
  SELECT tree, 0, pos, leaf, n FROM l
  UNION ALL
  SELECT tree, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM t WHERE n > 1 GROUP BY tree, level, pos // 2, n),
s AS MATERIALIZED (SELECT tree, h AS subroot, level AS height, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
r(level, pos, h, n) AS (
  SELECT 0, pos, subroot, n FROM s
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM r WHERE n > 1 GROUP BY level, pos // 2, n),
way AS MATERIALIZED (
  SELECT l.tree, l.pos AS leaf_pos, t.level AS step, (l.pos >> t.level) % 2 = 1 AS left_, o.h AS sibling
  FROM l JOIN (SELECT DISTINCT tree, level, n FROM t WHERE n > 1) t ON l.tree = t.tree
  LEFT JOIN t o ON o.tree = t.tree AND o.level = t.level AND o.pos = xor(l.pos >> t.level, 1)
  UNION ALL
  SELECT l.tree, l.pos, s.height + x.level, (s.pos >> x.level) % 2 = 1, o.h
  FROM l JOIN s ON l.tree = s.tree CROSS JOIN (SELECT DISTINCT level, n FROM r WHERE n > 1) x
  LEFT JOIN r o ON o.level = x.level AND o.pos = xor(s.pos >> x.level, 1)),
p AS (SELECT tree, leaf_pos, list(CASE WHEN sibling IS NULL THEN '' WHEN left_ THEN 'l' || sibling ELSE 'r' || sibling END ORDER BY step) AS steps,
             sha256(coalesce(string_agg(sibling, '' ORDER BY step), '')) AS proof_sha256 FROM way GROUP BY tree, leaf_pos)
SELECT l.doc_id, l.leaf, s.subroot, (SELECT h FROM r WHERE n = 1) AS root,
       coalesce(p.proof_sha256, sha256('')) AS proof_sha256, f.folded_root, f.folded_root = (SELECT h FROM r WHERE n = 1) AS verified
FROM l JOIN s ON l.tree = s.tree LEFT JOIN p ON p.tree = l.tree AND p.leaf_pos = l.pos,
LATERAL (SELECT list_reduce(list_prepend(l.start, coalesce(p.steps, [])),
         lambda h, x: CASE WHEN x[1] = 'l' THEN sha256(x[2:] || h) WHEN x[1] = 'r' THEN sha256(h || x[2:]) ELSE sha256(h) END) AS folded_root) f
"""
