"""Token arrays are mapped by the distinct terms of chunks of rows, not token by token."""

from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ratewise.functions import porter2
from ratewise.operators import coded, terms

ROWS = [(1, ["b", "a", None, "b"], "x"), (2, None, "y"), (3, [], None), (4, ["zz", "ä", "a"], "z"), (None, ["a"], "n"),
        (5, ["a", "q"], "one"), (5, ["b", "b", "q"], "two"), (5, None, "three")]
MAPPING = [("a", "A"), ("b", "B2"), ("b", "B1"), ("zz", None), (None, "never"), ("other", "O")]


def _by_rows(df, mapping, out):
    """Every token as a row, joined and put together again."""
    mapped = (df.select("id", F.posexplode("tokens").alias("pos", "term")).join(mapping, "term", "left")
              .select("id", "pos", F.coalesce("replacement", "term").alias("term"))
              .groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "term"))).alias("p")).select("id", F.col("p.term").alias("got")))
    return df.join(mapped, "id", "left").withColumn(out, F.coalesce("got", F.array().cast("array<string>"))).drop("got")


@pytest.mark.parametrize("out", [None, "words"])
def test_mapped_tokens_are_those_of_a_join_of_every_token(spark, out):
    df = spark.createDataFrame(ROWS, "id int, tokens array<string>, note string")
    mapping = spark.createDataFrame(MAPPING, "term string, replacement string").where("replacement <> 'B2' OR replacement IS NULL")
    got, want = terms.map_terms(df, "id", "tokens", mapping, out), _by_rows(df, mapping, out or "tokens")
    assert sorted(map(repr, got.select(*want.columns).collect())) == sorted(map(repr, want.collect()))
    assert [r.tokens for r in got.where("id = 1").collect()] == [["B1", "A", None, "B1"] if out is None else ["b", "a", None, "b"]]


def test_a_term_with_two_replacements_gives_both(spark):
    df = spark.createDataFrame(ROWS[:5], "id int, tokens array<string>, note string")
    mapping = spark.createDataFrame(MAPPING, "term string, replacement string")
    got = {r.id: r.tokens for r in terms.map_terms(df, "id", "tokens", mapping).collect()}
    assert got == {1: ["B1", "B2", "A", None, "B1", "B2"], 2: [], 3: [], 4: ["zz", "ä", "A"], None: []}


def test_no_token_is_a_row_of_the_join(spark):
    df = spark.createDataFrame([(1, ["a", "b"] * 500), (2, ["a"] * 300)], "id int, tokens array<string>")
    mapping = spark.createDataFrame(MAPPING[:1], "term string, replacement string")
    out = terms.map_terms(df, "id", "tokens", mapping)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "FlatMapCoGroupsInArrow" in plan
    rows, found = coded.encode(df, "tokens")
    assert found.count() <= 3 and sorted(rows.select("id", F.size("_codes")).collect()) == [(1, 1000), (2, 300)]


@pytest.mark.parametrize("limit", [1, 3, 1 << 20])
def test_chunks_hold_so_many_tokens_and_give_back_all_rows(monkeypatch, limit):
    monkeypatch.setattr(coded, "CHUNK_TOKENS", limit)
    tokens = [["a", "b", "a"], None, [], ["c"] * 5, [None, "b"], ["d"], ["a", "d"]]
    b = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(tokens, pa.list_(pa.string()))], ["id", "tokens"])
    out = [pa.Table.from_batches([x]) for x in coded._encode(iter([b.slice(1), b.slice(0, 1)]))]
    got, sizes = {}, Counter()
    for rows, terms_ in zip(out[::2], out[1::2]):
        assert rows["_chunk"].to_pylist() == terms_["_chunk"].to_pylist() * rows.num_rows
        words = terms_["_terms"][0].as_py()
        assert len(set(words)) == len(words)
        sizes[sum(map(len, rows["_codes"].to_pylist()))] += rows.num_rows > 1
        table = pa.table({"_code": pa.array(range(len(words)), pa.int32()), "_word": pa.array(words, pa.string())})
        for i, t in zip(*coded._decode(["id", "tokens"])(rows, table).to_pydict().values()):
            got[i] = t
    assert got == {i: t or [] for i, t in enumerate(tokens)}
    assert all(n <= limit for n, several in sizes.items() if several)


def test_stems_are_stored_and_their_code_is_cut_up(spark, monkeypatch):
    key, seen = "spark.sql.codegen.hugeMethodLimit", []
    before = spark.conf.get(key)
    monkeypatch.setattr(porter2, "stored", lambda df, name: seen.append(spark.conf.get(key)) or df)
    out = porter2.english_stem(spark.createDataFrame([("relational", 2)], "term string, n int"))
    assert seen == ["8000"] and spark.conf.get(key) == before
    assert [tuple(r) for r in out.collect()] == [("relational", 2, "relat")]
