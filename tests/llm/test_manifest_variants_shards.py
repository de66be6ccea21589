"""Merkle manifest, spelling variants and sharding against plain versions, on odd and skewed input."""

import hashlib
import heapq
import random
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ratewise.llm import fmindex, merkle, sharding, variants
from ratewise.llm.common import numbered
from ratewise.session import scratch_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def hexed(x: str) -> str:
    return hashlib.sha256(x.encode()).hexdigest()


def written(v) -> str:
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(doc, text, lang, source, n_chars):
    return hexed("".join(map(written, (doc, source, lang, n_chars, text))))


def levels_of(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([hexed("".join(out[-1][i:i + 2])) for i in range(0, len(out[-1]), 2)])
    return out


def way_of(levels, i):
    """(sibling or '', is the sibling on the left) per level"""
    out = []
    for level in levels[:-1]:
        j = i ^ 1
        out.append((level[j] if j < len(level) else "", j < i))
        i //= 2
    return out


def plain_manifest(rows):
    trees = {}
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(*r))):
        trees.setdefault(r[2], []).append(r)
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {lang: levels_of([leaf_of(*r) for r in trees[lang]]) for lang in order}
    top = levels_of([built[lang][-1][0] for lang in order])
    out = []
    for k, lang in enumerate(order):
        for i, r in enumerate(trees[lang]):
            way = way_of(built[lang], i) + way_of(top, k)
            spoilt = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None
            node = leaf_of(*r[:4], r[4] + 1) if spoilt else leaf_of(*r)
            for sibling, left in way:
                node = hexed(sibling + node if left else node + sibling)
            out.append((r[0], leaf_of(*r), built[lang][-1][0], top[-1][0], hexed("".join(s for s, _ in way)), node, node == top[-1][0]))
    return out


ODD = [(1, None, None, None, None), (2, "", "", "", 0), (7, "é" * 70000, "en", "s", 7), (None, "x", "en", "s", 1), (3, "x", "de", None, None),
       (2**60 + 1, "a b", "en", "s", 3), (5, "twin", "fr", "s", 4), (5, "twin", "fr", "s", 4), (6, "twin", "fr", "s", 4), (-4, "\n\t", "en", None, 2)]


def key(r):
    return tuple((x is not None, x) for x in r)


@pytest.mark.parametrize("height", [1, 2, 3, 8])
def test_manifest_equals_a_plain_one(spark, height):
    rnd = random.Random(height)
    rows = ODD + [(100 + i, f"text {i}", rnd.choice(["en", "en", "en", "de", "x́"]), "s", i) for i in range(150)] + [(9000, "alone", "zz", "s", 1)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({"tree": F.lit("clash"), "pos": F.lit(1), "leaf": F.lit(2)}).repartition(7)
    got = [tuple(r) for r in merkle.verify(docs, height).collect()]
    assert sorted(got, key=key) == sorted(plain_manifest(rows), key=key)
    bad = {r[0] for r in got if not r[6]}
    assert bad == {r[0] for r in rows if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0}


def test_manifest_of_little(spark):
    assert merkle.verify(spark.createDataFrame([], SCHEMA)).count() == 0
    one = merkle.verify(spark.createDataFrame([(3, "a", "en", "s", 1)], SCHEMA)).collect()[0]
    assert one.leaf == one.subroot == one.root == one.folded_root and one.proof_sha256 == hexed("") and one.verified


def test_layout_is_recursive_by_halves():
    for levels in range(1, 12):
        every = [merkle.addresses(levels, d, np.arange(1 << d)) for d in range(levels)]
        assert sorted(np.concatenate(every).tolist()) == list(range((1 << levels) - 1))
        top, below = levels // 2, levels - levels // 2
        if top:  # the top half lies first; each bottom subtree is one run of places, aligned to its size
            assert max(x.max() for x in every[:top]) == (1 << top) - 2
            for s in range(1 << top):
                run = np.concatenate([every[top + d][s << d:(s + 1) << d] for d in range(below)])
                assert run.min() == (1 << top) - 1 + s * ((1 << below) - 1) and run.max() - run.min() == (1 << below) - 2


def test_a_block_holds_the_siblings_of_its_leaves():
    rnd = random.Random(5)
    for n in (1, 2, 3, 5, 8, 13):
        height = max(n - 1, 0).bit_length()
        leaves = [rnd.randbytes(32) for _ in range(n)]
        nodes = merkle.build(leaves, height)
        plain = levels_of([x.hex() for x in leaves])
        assert nodes[:32].hex() == plain[-1][0]
        for i in range(n):
            steps = [(s.decode(), side == merkle.LEFT) for side, s in merkle.steps(merkle.path(nodes, height, n, i))]
            assert [(s, left) for s, left in steps if s] == [(s, left) for s, left in way_of(plain, i) if s]
            assert merkle.fold(leaves[i].hex().encode(), merkle.path(nodes, height, n, i)).decode() == plain[-1][0]


def test_numbers_have_no_gaps(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 7).cast("string"))).alias("g"),
                                  F.xxhash64("id").alias("o"), "id").repartition(9)
    got = numbered(df, "g", ["o"], "number").toPandas()
    for _, part in got.groupby("g"):
        part = part.sort_values("o")
        assert part["number"].tolist() == list(range(len(part)))


# ---- spelling variants

def one_apart(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


@pytest.mark.parametrize("letters, size, count", [("ab", 7, 60), ("abcé", 6, 300), ("a", 9, 9), ("abcdefghijÿ", 6, 400)])
def test_index_finds_every_error_behind_the_exact_half(letters, size, count):
    rnd = random.Random(3)
    words = sorted({"".join(rnd.choice(letters) for _ in range(rnd.randint(4, size))) for _ in range(count)})
    asked = words + ["".join(rnd.choice(letters + "z") for _ in range(rnd.randint(4, size + 1))) for _ in range(100)]
    a, b = fmindex.WordIndex(words).search(asked, [len(w) // 2 for w in asked])
    got = [(asked[i], words[j]) for i, j in zip(a, b)]
    assert sorted(set(got)) == sorted({(x, y) for x in asked for y in words if one_apart(x, y) and x[:len(x) // 2] == y[:len(x) // 2]})
    assert len(set(zip(a.tolist(), b.tolist()))) == len(a)


def test_index_intervals_stay_in_step():
    words = ["banana", "bandana", "ananas", "nab"]
    ix = fmindex.WordIndex(words)
    p, size = ix.codes(["banana", "nabob", "ananas"])
    q, lo, hi = ix._half(p, np.array([3, 3, 3]))
    assert dict(zip(q.tolist(), (hi - lo).tolist())) == {0: 2, 1: 1, 2: 1}  # words that begin so


@pytest.mark.parametrize("cell, batch", [(1 << 18, 1 << 20), (300, 200), (60, 50)])
def test_pairs_are_the_same_however_the_vocabulary_is_cut(spark, cell, batch):
    rnd = random.Random(8)
    # one edge ("ab" ... ) holds a third of the words
    words = {"ab" + "".join(rnd.choice("xyz") for _ in range(rnd.randint(3, 5))) for _ in range(120)}
    words |= {"".join(rnd.choice("abcde") for _ in range(rnd.randint(5, 7))) for _ in range(250)}
    df = spark.createDataFrame([(w, i + 3) for i, w in enumerate(sorted(words))], "word string, n long")
    path = scratch_path(spark, "words")
    df.write.parquet(path)
    got = [(r.word, r.near) for r in variants.near_pairs(spark.read.parquet(path), cell, batch).collect()]
    assert len(got) == len(set(got)) and set(got) == {(a, b) for a in words for b in words if one_apart(a, b)}


def plain_variants(rows):
    import re
    count = {}
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            word = variants.spoil("" if doc is None else str(doc), run)
            count[word] = count.get(word, 0) + 1
    count = {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}
    form, near = {}, {}
    for w, n in count.items():
        close = [v for v in count if one_apart(w, v)]
        near[w] = len(close)
        best = min(close, key=lambda v: (-count[v], v), default=None)
        form[w] = best if best and count[best] >= 2 * n else None

    def root(w):
        return root(form[w]) if form[w] else w
    return {(w, form[w], root(w), n, near[w], count.get(form[w])) for w, n in count.items()}


def test_variants_equal_a_plain_version(spark):
    rnd = random.Random(4)
    base = ["color", "colour", "colours", "Élan vital", "straße", "naïve", "lights", "light", "flights", "slight", "mañana", "x" * 3000]
    rows = [(i, " ".join(w if rnd.random() < 0.7 else w[:2] + rnd.choice("aeé") + w[3:] for w in rnd.choices(base, k=25))) for i in range(120)]
    rows += [(None, "colour colour colour"), (7, None), (8, ""), (9, "1234 ...")] + [(500, "lights lighte COLOR")] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"word": F.lit("clash"), "n": F.lit(1)})
    got = [tuple(r) for r in variants.variants(docs).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_variants(rows)
    assert variants.variants(docs.limit(0)).count() == 0


def test_chains_are_followed_to_their_end(spark):
    chain = [(f"w{i}", f"w{i + 1}") for i in range(37)] + [("side", "w5")]
    got = {r.word: r.root for r in variants.follow(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert got == {w: "w37" for w, _ in chain}


# ---- sharding

def heap_loads(sizes, shards):
    heap = [(0, s) for s in range(shards)]
    for size in sorted(sizes, reverse=True):
        load, s = heap[0]
        heapq.heapreplace(heap, (load + size, s))
    return sorted(load for load, _ in heap)


def test_schedule_deals_classes_as_the_heap_deals_groups():
    rnd = random.Random(6)
    for _ in range(60):
        shards = rnd.choice([1, 2, 5, 16])
        sizes = rnd.sample(range(1, 500), rnd.randint(1, 12))
        counts = [rnd.choice([1, 2, 17, 33, 200, 1000]) for _ in sizes]
        plan = sharding.schedule(pd.DataFrame({"class": range(len(sizes)), "size": [float(x) for x in sizes], "n": counts}), shards)
        load = dict.fromkeys(range(shards), 0)
        for c, part in plan.groupby("class"):
            part = part.sort_values("first")
            assert part["first"].iloc[0] == 0 and part["last"].iloc[-1] == counts[c] and (part["first"].iloc[1:].values == part["last"].iloc[:-1].values).all()
            for r in part.itertuples():
                load[r.shard] += (r.last - r.first) * sizes[c]
        assert sorted(load.values()) == heap_loads([s for s, n in zip(sizes, counts) for _ in range(n)], shards)


def check_shards(rows, got, shards=16):
    assert sorted(map(key, ((r.doc_id, r.size) for r in got))) == sorted(map(key, ((d, len((t or "").encode()) + 1) for d, t in rows)))
    for s in range(shards):
        mine = sorted((r for r in got if r["shard"] == s), key=lambda r: r.slot)
        assert [r.slot for r in mine] == list(range(len(mine)))
        assert [r.doc_id for r in mine] == sorted((r.doc_id for r in mine), key=lambda d: (d is not None, d))
    text = {}
    for d, t in rows:
        text.setdefault(d, set()).add(t or "")
    home = {}
    for r in got:
        if len(text[r.doc_id]) == 1:
            home.setdefault(next(iter(text[r.doc_id])), set()).add(r["shard"])
    assert all(len(x) == 1 for x in home.values())


def test_shards_of_distinct_texts_are_the_heaps(spark):
    rnd = random.Random(7)
    rows = [(i, f"{i} " + "x" * rnd.choice([3, 20, rnd.randint(0, 400)])) for i in range(1500)]
    rows += [(5000 + i, "copied text " * 9) for i in range(60)]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    check_shards(rows, got)
    sizes = {}
    for _, t in rows:
        sizes[t] = sizes.get(t, 0) + len(t) + 1
    loads = [sum(r.size for r in got if r["shard"] == s) for s in range(16)]
    assert sorted(loads) == heap_loads(sizes.values(), 16)
    assert all(r.law == "bytes" and r.grown_shard is None and r.text_crc32 == zlib.crc32(dict(rows)[r.doc_id].encode()) for r in got)


def test_shards_of_odd_and_skewed_input(spark):
    rows = ([(i, "a third of all rows") for i in range(700)] + [(1000 + i, f"own {i}") for i in range(1300)] + [(None, "own 3"), (3009, None), (3009, None), (3010, "")]
            + [(4000, "é" * 70000), (4001, "y" * 90000)])
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"shard": F.lit("clash"), "digest": F.lit(1), "size": F.lit(2)})
    got = sharding.shard(df).collect()
    check_shards(rows, got)
    assert {r.size for r in got if r.doc_id == 3009} == {1} and {r.text_crc32 for r in got if r.doc_id == 3009} == {0}
    assert len({r["shard"] for r in got if r.doc_id in (3009, 3010)}) == 1
    assert sharding.shard(df.limit(0)).count() == 0
    few = sharding.shard(df.where("doc_id = 1000")).collect()
    assert [(r["shard"], r.slot) for r in few] == [(0, 0)]


def test_size_classes_agree_in_leading_bits(spark):
    sizes = [1, 2, 511, 512, 513, 1023, 1024, 1026, 1 << 40, (1 << 40) + 1]
    got = [r.c for r in spark.createDataFrame([(s,) for s in sizes], "bytes long").select(sharding.size_class(F.col("bytes")).alias("c")).collect()]
    assert all(0 <= s + c < max(1, s / 256 + 1) for s, c in zip(sizes, got)) and got[:3] == [-1, -2, -511]
