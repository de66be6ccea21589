"""Spelling variant grouping by a bidirectional FM-index search scheme.

Two words one error apart agree in one of their halves. So each word is looked up twice in an index
of the vocabulary: with its first half exact and one error allowed across the second, and with its
second half exact and the error in the first (the same search on the words read backwards).

The vocabulary is laid out in cells. Words that agree in a half agree in their two outer letters, so
the forward search only needs words with the same first two letters, the backward one those with the
same last two; cells are hashed from these, and a cell that is too large for one index is cut by word
length (a partner is at most one letter longer or shorter) and then by hash, and its words are looked
up in each part. Every index and every batch of words looked up in it has a bounded size.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ship, stored
from .fmindex import WordIndex

#: Fixed values of the word definition.
LETTERS = "A-Za-zÀ-ÿ"
LEAST_LETTERS = 5
LEAST_COUNT = 3
SPOILT = 97
#: A form is at least so many times as frequent as its variant.
RATIO = 2
#: Letters of text in one index, and letters of words looked up in it by one task.
CELL = 1 << 18
BATCH = 1 << 20
_HELD = 200_000


def spoil(doc: str, run: str) -> str:
    """The run, without one letter for a share of the (document, run) pairs that their checksum picks."""
    h = zlib.crc32(f"{doc}:{run}".encode())
    if h % SPOILT:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1:]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # shorter runs cannot give a word; bytes.lower() lowers A-Z only
    runs = re.compile(f"[{LETTERS}]{{{LEAST_LETTERS},}}").findall
    held: dict[str, int] = {}

    def out():
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

    for b in batches:
        docs, texts = b.column(0), b.column(1)
        for i in range(b.num_rows):
            text, doc = texts[i].as_py(), docs[i].as_py()
            if text:
                head = zlib.crc32(f"{doc}:".encode())
                for run, n in Counter(runs(text.encode().lower().decode())).items():
                    if zlib.crc32(run.encode(), head) % SPOILT == 0:
                        run = spoil(doc, run)
                        if len(run) < LEAST_LETTERS:
                            continue
                    held[run] = held.get(run, 0) + n
                if len(held) > _HELD:
                    yield out()
                    held.clear()
    yield out()


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): words of at least ``LEAST_LETTERS`` letters and ``LEAST_COUNT`` occurrences."""
    named = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("doc"), F.col(text).alias("text"))
    return (named.mapInArrow(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= LEAST_COUNT))


_PAIR = pa.schema([("word", pa.string()), ("near", pa.string()), ("near_n", pa.int64())])


def _lookup(key: tuple, rows: pa.Table) -> pa.Table:
    """Words with a count are the index, words without one are looked up in it."""
    back = key[0].as_py().startswith("b")
    held = [(w, n) for w, n in zip(rows["word"].to_pylist(), rows["n"].to_pylist()) if n is not None]
    asked = rows.filter(rows["n"].is_null())["word"].to_pylist()
    if not held or not asked:
        return _PAIR.empty_table()
    exact = [len(w) - len(w) // 2 if back else len(w) // 2 for w in asked]
    turn = (lambda w: w[::-1]) if back else (lambda w: w)
    a, b = WordIndex([turn(w) for w, _ in held]).search([turn(w) for w in asked], exact)
    out = [(asked[i], *held[j]) for i, j in zip(a.tolist(), b.tolist())]
    if back:  # where the first halves agree, the forward search finds the pair too
        out = [x for x in out if not x[1].startswith(x[0][:len(x[0]) // 2])]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _PAIR.types)], schema=_PAIR) if out else _PAIR.empty_table()


def near_pairs(words: DataFrame, cell: int = CELL, batch: int = BATCH) -> DataFrame:
    """(word, near, near_n) for all ordered pairs of ``words`` (word, n; stored, distinct, at least four
    letters each) that differ by one inserted, deleted or replaced letter; each pair once."""
    letters = words.agg(F.sum(F.length("word") + 1).alias("s")).first()["s"] or 0
    cells = max(1, -(-letters // cell))
    edge = [F.substring("word", 1, 2), F.expr("right(word, 2)")]
    sides = words.select("word", "n", F.length("word").alias("size"), F.explode(F.array(
        *[F.concat(F.lit(d), F.pmod(F.xxhash64(e), F.lit(cells)).cast("string")) for d, e in zip("fb", edge)])).alias("home"))
    # one row per cell and word length: how the cell is cut
    sizes = stored(sides.groupBy("home", "size").agg(F.sum(F.col("size") + 1).alias("letters")), "cell-sizes")
    before = F.coalesce(F.sum("letters").over(Window.partitionBy("home").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = F.ceil(F.col("letters") / cell)
    cut = sizes.withColumn("parts", parts).withColumn("group", F.when(F.col("parts") > 1, -F.col("size").cast("long")).otherwise(F.floor(before / cell)))
    sections = cut.groupBy("home", "group").agg(F.min("size").alias("low"), F.max("size").alias("high"), F.max("parts").alias("parts"))
    asked = (sections.join(sizes.select("home", F.col("size").alias("s"), "letters"), "home")
             .where(F.col("s").between(F.col("low") - 1, F.col("high") + 1)).groupBy("home", "group", "low", "high", "parts")
             .agg(F.ceil(F.sum("letters") / batch).alias("batches")))
    sections = stored(asked, "sections")

    def name(part, number):
        return F.concat_ws(":", "home", "group", part.cast("string"), number.cast("string"))

    index = (sides.join(sections, (sides["home"] == sections["home"]) & sides["size"].between(F.col("low"), F.col("high")))
             .drop(sections["home"]))
    # a length with parts of its own lies in no other section
    index = index.join(cut.select("home", "size", F.col("group").alias("own")), ["home", "size"]).where(F.col("own") == F.col("group"))
    index = (index.withColumn("number", F.explode(F.sequence(F.lit(0).cast("long"), F.col("batches") - 1)))
             .select("word", "n", name(F.pmod(F.xxhash64("word"), F.col("parts")), F.col("number")).alias("cell")))
    patterns = (sides.join(sections, (sides["home"] == sections["home"]) & sides["size"].between(F.col("low") - 1, F.col("high") + 1))
                .drop(sections["home"]).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
                .select("word", F.lit(None).cast("long").alias("n"), name(F.col("part"), F.pmod(F.xxhash64("word", F.lit(1)), F.col("batches"))).alias("cell")))
    return index.unionByName(patterns).groupBy("cell").applyInArrow(_lookup, "word string, near string, near_n long")


def follow(forms: DataFrame, max_rounds: int = 40) -> DataFrame:
    """(word, root) for ``forms`` (word, form): the last of the chain word, form, form's form, ...

    A form is at least ``RATIO`` times as frequent, so chains are short; each round doubles the part
    of the chain that a row has behind it. ``max_rounds`` only guards against a defect."""
    links = stored(forms.select("word", F.col("form").alias("root")), "forms")
    for _ in range(max_rounds):
        step = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = stored(links.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                               F.col("further").isNotNull().alias("moved")), "forms")
        links = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return links
    raise RuntimeError("chains of forms did not end")


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n), one row per word of the corpus.

    Null or empty text has no words; a null key is written as an empty string where a run's checksum
    is taken. Repeated rows count like any other. Equal frequencies: the form that is smallest in
    code-point order. An empty table gives no rows. Other columns are ignored.

    What is shuffled is (word, count) per task, then the vocabulary.
    """
    ship(docs.sparkSession)
    words = stored(vocabulary(docs, key, text), "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("m"), "near")).alias("best")
    near = near_pairs(words).groupBy("word").agg(F.count("*").alias("n_near"), best)
    rows = words.join(near, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                                                   F.col("best.near").alias("near"), (-F.col("best.m")).alias("near_n"))
    strong = F.col("near_n") >= RATIO * F.col("n")
    rows = stored(rows.select("word", "n", "n_near", F.when(strong, F.col("near")).alias("form"),
                              F.when(strong, F.col("near_n")).alias("form_n")), "words")
    roots = follow(rows.where("form IS NOT NULL"))
    return rows.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def oracle() -> str:
    """The same in SQL: pairs by equal words without one letter at the same place (replaced) or by a
    word without one letter that is a word (inserted, deleted)."""
    table = ("(SELECT list(c ORDER BY i) FROM (SELECT i, list_reduce(list_prepend(i, range(8)), "
             "lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i)))")
    octets = "list_transform(range(length(hx) // 2), lambda i: CAST('0x' || hx[2 * i + 1:2 * i + 2] AS BIGINT))"
    return f"""
WITH RECURSIVE k AS MATERIALIZED (SELECT {table} AS t),
r AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[{LETTERS}]+')) AS run FROM documents),
c AS (SELECT run, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS hx, count(*) AS n FROM r
      WHERE length(run) >= {LEAST_LETTERS} GROUP BY doc_id, run),
h AS (SELECT run, n, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {octets}),
             lambda c, b: xor(c >> 8, k.t[(xor(c, b) & 255) + 1]))) AS h FROM c, k),
w AS (SELECT CASE WHEN h % {SPOILT} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM h),
v AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM w WHERE length(word) >= {LEAST_LETTERS} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}),
d AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
                   FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
p AS (SELECT a.word, b.word AS near, b.n AS near_n FROM d a JOIN d b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
      UNION SELECT d.word, v.word, v.n FROM d JOIN v ON d.rest = v.word
      UNION SELECT v.word, d.word, d.n FROM d JOIN v ON d.rest = v.word),
b AS (SELECT word, count(*) AS n_near, max(near_n) AS top FROM p GROUP BY word),
f AS MATERIALIZED (
  SELECT v.word, v.n, coalesce(b.n_near, 0) AS n_near,
         CASE WHEN b.top >= {RATIO} * v.n THEN (SELECT min(p.near) FROM p WHERE p.word = v.word AND p.near_n = b.top) END AS form,
         CASE WHEN b.top >= {RATIO} * v.n THEN b.top END AS form_n
  FROM v LEFT JOIN b ON v.word = b.word),
t(word, last) AS (SELECT word, coalesce(form, word) FROM f UNION SELECT t.word, f.form FROM t JOIN f ON t.last = f.word WHERE f.form IS NOT NULL),
z AS (SELECT t.word, t.last AS root FROM t JOIN f ON t.last = f.word WHERE f.form IS NULL)
SELECT f.word, f.form, z.root, f.n, f.n_near, f.form_n FROM f JOIN z ON f.word = z.word
"""
