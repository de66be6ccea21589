"""Corpus pipeline: documents through the corpus operators, stage by stage.

Each stage is written as Parquet and read again before the next, so a lost executor never sets the
run back further than the stage it is in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratewise.llm import langid, linededup, mixing, neardup, packing
from ratewise.llm.common import drop_stored, stored, stored_so_far, table
from ratewise.llm.queries import PIECES, WORD_TOKENIZER

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A language is accepted from this posterior probability on ...
LEAST_SCORE = 0.5
#: ... if at least this share of the text's letters are letters of it: the posterior only compares the
#: languages that were learned, and is sure of one of them for any text in a script of none.
LEAST_FAMILIAR = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an accepted language go; a null ``lang`` is filled with the prediction.

    Text that is null or has no letter, or is mostly in letters that the language does not have, has no
    accepted language. The model is fitted on the documents that
    have a ``lang``; if none has, nothing can be identified and nothing is rejected.
    """
    model = langid.fit(docs, PIECES)
    if not model.langs:
        return docs.select(*COLUMNS)
    found = langid.identify(docs, model, keep=COLUMNS, familiar=True)
    return (found.where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LEAST_SCORE) & (F.col("familiar") >= LEAST_FAMILIAR))
            .withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source are taken out; a document left without text goes."""
    out = linededup.drop_boilerplate(docs)
    gone = (F.col("n_dropped") > 0) & (F.trim(F.translate("text", "\n\r\t", "   ")) == "")
    return (out.where(~F.coalesce(gone, F.lit(False)))
            .withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that with the smallest id: five-word
    shingles, similarity 0.8 or more. Rows that repeat an id are one document; one of them stays."""
    found = neardup.near_duplicates(docs, words=5)
    drop = found.where("NOT kept").select("doc_id").distinct()
    stay = docs.join(drop, "doc_id", "left_anti").select(*COLUMNS)
    named = stay.where("doc_id IS NOT NULL")
    first = F.min(F.struct("text", "lang", "source", "n_chars")).alias("row")
    repeated = named.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    one = (named.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(first)
           .select("doc_id", "row.*").select(*COLUMNS))
    return stay.join(repeated, "doc_id", "left_anti").unionByName(one)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled so that the token shares of sources, languages and topics meet the
    targets, ``mixing.KEEP`` of the tokens. The sample is the stage's purpose; nothing else is dropped.
    Text that is null or blank has no token, belongs to no cell and is not sampled; a null source or
    language is a value of its own; rows that repeat an id are sampled together."""
    return mixing.mix(docs, sweeps=None, keep=mixing.KEEP).where("sampled").select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in the training sequences. Null or empty text is one
    piece, the end id alone; rows that repeat an id are packed each; an empty table gives no rows."""
    return packing.pack(docs, WORD_TOKENIZER)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("source_mixing", source_mixing), ("packing", pack)]

#: Language models, signatures and the packing plan are not expressible in SQL: tests/llm holds
#: the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, mark = table(spark, sf_dir, "documents").select(*COLUMNS), stored_so_far()
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, f"pipeline-{name}")
            drop_stored(spark, mark, keep=1)  # the stage's own tables and its input are not read again
    return docs
