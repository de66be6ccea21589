"""Registered queries of the corpus operators, and their DuckDB oracles where SQL has one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (langid, licenses, linededup, merkle, metricjoin, mixing, neardup, orderminhash, packing, quality, sharding,
               variants, warc)
from .common import table

#: Files of public tokenizers (see their README); any other path can be given to the operators.
WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

QUERIES = {}
ORACLES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = linededup.drop_boilerplate(docs)
    return out.select("doc_id", "source", "n_lines", "n_dropped", "text")


ORACLES["op8_line_dedup"] = f"""
WITH l AS (
  SELECT rowid AS r, source, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM (SELECT row_number() OVER () AS rowid, source, text FROM documents)),
k AS (SELECT *, trim(line, chr(32) || chr(9) || chr(13)) AS key FROM l),
n AS (SELECT source, count(*) AS total FROM documents GROUP BY source),
b AS (
  SELECT k.source, key FROM k JOIN n ON k.source IS NOT DISTINCT FROM n.source
  WHERE key <> '' GROUP BY k.source, key, total
  HAVING count(DISTINCT r) >= {linededup.MIN_PAGES} AND count(DISTINCT r) > total * CAST({linededup.RATIO} AS DOUBLE)),
c AS (
  SELECT k.r, k.i, k.line, b.key IS NOT NULL AS gone
  FROM k LEFT JOIN b ON k.source IS NOT DISTINCT FROM b.source AND k.key = b.key),
g AS (
  SELECT r, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '') AS text
  FROM c GROUP BY r)
SELECT d.doc_id, d.source, coalesce(g.n_lines, 0) AS n_lines, coalesce(g.n_dropped, 0) AS n_dropped,
       CASE WHEN d.text IS NOT NULL THEN g.text END AS text
FROM (SELECT row_number() OVER () AS rowid, * FROM documents) d LEFT JOIN g ON g.r = d.rowid
"""


@query
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return licenses.scan(docs)


ORACLES["op4_license_scan"] = licenses.oracle()


@query
def op3_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    return (mixing.mix(docs, sweeps=None, keep=mixing.KEEP).drop("text")
            .withColumns({"factor": F.round("factor", 6), "p": F.round("p", 6)}))


ORACLES["op3_source_mixing"] = mixing.oracle()


@query
def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), words=4)


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    model = langid.fit(docs.where(fold != 2), PIECES)
    held_out = F.coalesce(fold == 2, F.lit(False)).alias("held_out")
    return langid.identify(docs, model).select("doc_id", held_out, "lang_pred", "score")


@query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), WORD_TOKENIZER)


@query
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


ORACLES["op10_warc"] = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
q AS (SELECT page_id, strlen(body) AS payload_bytes, sha256(body) AS payload_digest,
             min(page_id) OVER (PARTITION BY body) AS first FROM p),
r AS (SELECT *, payload_bytes >= {warc.REVISIT_BYTES} AND page_id <> first AS again FROM q)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN first END AS refers_to FROM r
"""


@query
def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metricjoin.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op7_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orderminhash.fingerprints(table(spark, sf_dir, "documents"))


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"))


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(table(spark, sf_dir, "documents"))


ORACLES["op11_merkle_manifest"] = merkle.oracle()


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(table(spark, sf_dir, "documents"))


ORACLES["op12_spelling_variants"] = variants.oracle()


@query
def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"))
