"""Texts are cut the same way whether or not they take the quick path."""

import re

from pyspark.sql import functions as F

from ratewise.functions import text as tx
from ratewise.functions.stopwords import ENGLISH


def test_every_white_space_character_parts_words(spark):
    texts = [f"aa{c}bb{c}{c} the <i>x</i> cats{c}" for c in [*tx.WHITESPACE_CHARS, " "]] + ["no ä é “quote” – dash…", "", "a<b c", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select("t", tx.tokenize("t").alias("a"), tx.clean_tokens("t", "raw").alias("r"), tx.clean_tokens("t", "eda").alias("e"),
                    tx.cleaned_length("t").alias("n")).collect()
    for r in got:
        if r.t is None:
            assert r.a is None and r.r is None and r.e is None
            continue
        assert r.a == r.t.split()
        bare = re.sub(r"[!-/:-@\[-`{-~]", "", r.t).lower()
        assert r.r == [w for w in bare.split() if w not in ENGLISH]
        assert r.n == len(r.e)


def test_plain_texts_are_not_gone_through_by_character(spark):
    df = spark.createDataFrame([("ab cd\nef",)], "t string")
    plan = df.select(F.size(tx.blank_split("t")))._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.index("contains") < plan.index("translate")  # only where it may be needed
