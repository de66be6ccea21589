"""Counts made from blank-cut pieces are those of the tokens of whole texts."""

import random
import re
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ratewise.functions import text as tx
from ratewise.functions.stopwords import ENGLISH
from ratewise.operators import pieces, terms
from ratewise.plans import jobs

BITS = ["the", "The", "a", "cats", "Cats,", "dog's", "don't", "naïve", "für", "ÄPFEL", "İstanbul", "K", "theK", "٣", "the٣", "3", "3rd", "--", "-", "_",
        "__", "'tis", "\t", "a\tb", "cats\tdogs", "the of", "<", "<b>", "a<b", "c>d", "“quote”", "日本", "ไทย", "ſo", "é", "\x1c", "Straße", "𝒳", "😀", "ies", "a_b", "½"]


def _texts(n=600):
    rnd = random.Random(5)
    return [rnd.choice(["", " ", "\n"]) + "".join(rnd.choice(BITS) + rnd.choice([" ", " ", "\n", "  ", ", ", ""]) for _ in range(rnd.randint(0, 30)))
            for _ in range(n)] + [None, "", " "]


def _rows(df):
    return sorted(map(repr, map(tuple, df.collect())))


def test_counts_from_pieces_are_those_of_whole_texts(spark):
    rows = [(t, None if i % 7 == 0 else float(i % 3)) for i, t in enumerate(_texts())]
    df = spark.createDataFrame(rows, "t string, r double")
    for profile in ("eda", "raw", "stem"):
        toks = df.select("r", F.explode_outer(tx.clean_tokens("t", profile)).alias("term")).where("term IS NOT NULL")
        assert _rows(terms.term_counts(df, "t", profile, by=["r"])) == _rows(toks.groupBy("r", "term").agg(F.count("*").alias("n")))
    two = terms.vocabulary(df.select(tx.bigrams(tx.clean_tokens("t", "eda")).alias("p")), "p", term="bigram")
    assert _rows(terms.bigram_counts(df, "t")) == _rows(two)
    w = F.col("w")
    found = df.select(tx.cloud_words("t").alias("w")).select(F.explode_outer(F.transform(w, lambda x, i: F.struct(x.alias("a"), F.get(w, i + 1).alias("b")))).alias("p"))
    want = found.where("p IS NOT NULL").groupBy("p.a", "p.b").agg(F.count("*").alias("n"))
    got = pieces.neighbour_counts(df, F.col("t"), pieces.settle_cloud, tx.cloud_words, []).groupBy("a", "b").agg(F.sum("n").alias("n"))
    assert _rows(got) == _rows(want)


@pytest.mark.parametrize("limits", [{}, {"MOST": 8}, {"MOST_NAMES": 3}, {"MOST_BYTES": 40}, {"PART_BYTES": 30}, {"OUT_ROWS": 2}])
def test_what_a_task_holds_does_not_change_the_counts(monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(pieces, name, value)
    texts = [t for t in _texts(200)]
    groups = [i % 3 if i % 5 else None for i in range(len(texts))]
    batches = [pa.RecordBatch.from_arrays([pa.array(groups[i:i + 60], pa.int64()), pa.array(texts[i:i + 60], pa.string())], ["g", "t"]).slice(1) for i in range(0, len(texts), 60)]
    want = Counter()
    for b in batches:
        for g, t in zip(*[c.to_pylist() for c in b.columns]):
            want.update((g, p) for p in re.split("[ \n]", t or "") if p)
    got, out = Counter(), list(pieces._count(["g", "t"])(iter(batches)))
    for b in out:
        for g, p, n in zip(*[c.to_pylist() for c in b.columns]):
            got[g, p] += n
    assert got == want
    whole, cut = Counter(), Counter()
    for b in pieces._spans(pieces.settle_eda, list(ENGLISH))(b.select(["t"]) for b in batches):
        for h, t, plain, n in zip(*[c.to_pylist() for c in b.columns]):
            cut[h, t, plain] += n
    for name in limits:
        monkeypatch.undo()
    for b in pieces._spans(pieces.settle_eda, list(ENGLISH))(b.select(["t"]) for b in batches):
        for h, t, plain, n in zip(*[c.to_pylist() for c in b.columns]):
            whole[h, t, plain] += n
    assert cut == whole and whole
    if "MOST" in limits or "MOST_NAMES" in limits:
        assert len(out) > 1  # given out before the end


@pytest.mark.parametrize("make", [
    lambda df: terms.term_counts(df, "reviewText", "eda", by=["overall"]), lambda df: terms.term_counts(df, "reviewText", "raw"),
    lambda df: terms.top_bigrams(df, text="reviewText")])
def test_no_row_is_made_of_a_token(spark, make):
    df = spark.createDataFrame([("some words here and there", 5.0)], "reviewText string, overall double")
    plan = make(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan
    below = plan[plan.index("MapInArrow"):]
    assert "Generate" not in below and "split(" not in below


def test_the_term_cloud_goes_through_the_texts_once(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(terms, "cut_lineage", lambda df: kept.append(df) or df.sparkSession.createDataFrame(df.collect(), df.schema))
    out = terms.term_cloud_weights(spark.createDataFrame([("cats cat dogs",)], "reviewText string"))
    assert len(kept) == 1 and "MapInArrow" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert {r.word: r.n for r in out.collect()} == {"cat": 2, "dogs": 1}


def test_the_profile_job_stores_lengths_not_tokens(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(jobs, "cut_lineage", lambda df: kept.append(df) or df)
    df = spark.createDataFrame([("B1", 5.0, True, "good cats and dogs", "U1", "s", 1, "3")],
                               "asin string, overall double, verified boolean, reviewText string, reviewerID string, summary string, unixReviewTime int, vote string")
    jobs.eda_tables(df)
    assert [d.dtypes for d in kept] == [[("length", "double")]]


@pytest.mark.parametrize("limits", [{}, {"MOST": 8}, {"PART_BYTES": 30}])
def test_one_pass_gives_what_the_tables_need_of_the_texts(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(pieces, name, value)
    rows = [(t, None if i % 7 == 0 else float(i % 8)) for i, t in enumerate(_texts(300))]
    df = spark.createDataFrame(rows, "reviewText string, overall double").coalesce(2)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    if limits:  # in this process, where the limits hold
        batch = pa.RecordBatch.from_arrays([pa.array([r for _, r in rows]), pa.array([3] * len(rows), pa.int32()), pa.array([t for t, _ in rows])], ["rating", "use", "text"])
        made = pa.Table.from_batches(pieces._profile(list(ENGLISH))(iter([batch])))
        counted = Counter()
        for r in made.to_pylist():
            counted[r["kind"], r["head"], r["tail"], r["rating"]] += r["n"] or 0
        for name in limits:
            monkeypatch.undo()
        whole = Counter()
        for r in pa.Table.from_batches(pieces._profile(list(ENGLISH))(iter([batch]))).to_pylist():
            whole[r["kind"], r["head"], r["tail"], r["rating"]] += r["n"] or 0
        assert counted == whole
        return
    got = terms.text_profile(df)
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert _rows(got["lengths"]) == _rows(df.select(tx.cleaned_length("reviewText").alias("length")))
    assert _rows(got["by_rating"]) == _rows(terms.term_counts(df.where(F.col("overall").isin(1, 2, 3, 4, 5)), "reviewText", "eda", by=["overall"]))
    assert _rows(got["raw"]) == _rows(terms.term_counts(df, "reviewText", "raw"))
    assert _rows(got["pieces"]) == _rows(pieces.piece_counts(df, F.col("reviewText"), term="piece"))
    assert _rows(got["bigrams"]) == _rows(terms.bigram_counts(df, "reviewText"))


def test_the_profile_job_goes_through_the_texts_once(spark):
    df = spark.createDataFrame([("B1", 5.0, True, "good cats and dogs", "U1", "s", 1, "3")],
                               "asin string, overall double, verified boolean, reviewText string, reviewerID string, summary string, unixReviewTime int, vote string")
    for name, made in jobs.eda_tables(df).items():
        if name != "info":
            assert "reviewText" not in made._jdf.queryExecution().optimizedPlan().toString(), name


def test_the_words_of_cloud_pairs_meet_no_pattern_if_they_begin_with_a_letter(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(terms, "cut_lineage", lambda df: kept.append(df) or df.sparkSession.createDataFrame(df.collect(), df.schema))
    texts = ["red fox's red fox", "red foxs 12 it's 't's x's's 12's ٣٣ red fox 1a", "the 's of"] * 9
    got = {r.word: r.n for r in terms.term_cloud_pairs(spark.createDataFrame([(t,) for t in texts], "reviewText string"), k=50, least=1e9).collect()}
    assert got == {"red": 36, "fox": 36, "x's": 9, "1a": 9}
    plan = kept[1]._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan and "CASE WHEN" in plan
