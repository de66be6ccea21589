"""The ``reviews`` table derived from the driver's TPC-H-like tables.

Both engines build it from the same rule (see FIXTURES.md): Spark with DataFrame code here,
DuckDB with the SQL text of :func:`reviews_sql`. The join of lineitem and orders is a plain
equi-join (sort-merge at scale, broadcast if AQE finds a side small at runtime).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def reviews_view(spark: SparkSession, sf_dir: str, with_text: bool = True) -> DataFrame:
    """Reviews with the 8-column review schema; ``with_text=False`` fills reviewText with null
    and skips the documents join (use it where text is not read)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    df = li.join(orders, li.l_orderkey == orders.o_orderkey)
    if with_text:
        docs = table(spark, sf_dir, "documents").select("doc_id", "text")
        n_docs = docs.select(F.count(F.lit(1))).scalar()
        df = df.withColumn("_doc", (F.col("l_orderkey") * 7 + F.col("l_linenumber")) % n_docs)
        # dealt by the join key: co-located with the documents where those are too many to broadcast. The number of
        # partitions is the session's: by the bytes of these narrow rows, AQE would put long texts into few tasks
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        df = df.repartition(parts, "_doc").join(docs, F.col("_doc") == docs.doc_id)
        text = F.col("text")
    else:
        text = F.lit(None).cast("string")
    qty = F.col("l_quantity").cast("int")
    return df.select(
        F.concat(F.lit("B"), F.col("l_partkey").cast("string")).alias("asin"),
        (F.lit(1) + (qty + F.col("l_partkey")) % 5).cast("double").alias("overall"),
        (F.col("l_returnflag") != "R").alias("verified"),
        text.alias("reviewText"),
        F.concat(F.lit("U"), F.col("o_custkey").cast("string")).alias("reviewerID"),
        F.when(F.col("l_linenumber") == 7, F.lit(None)).otherwise(F.col("o_orderpriority")).alias("summary"),
        F.unix_timestamp("l_shipdate").cast("int").alias("unixReviewTime"),
        F.when(F.col("l_returnflag") == "N", F.lit(None))
         .when(F.col("l_quantity") >= 45, F.concat(F.lit("1,0"), qty.cast("string")))
         .otherwise(qty.cast("string")).alias("vote"),
    )


def reviews_sql(with_text: bool = True) -> str:
    """DuckDB text of the same table, to be used as ``WITH reviews AS (...)``. The text is looked
    up by a correlated subquery (DuckDB decorrelates it into a join; the plain join form trips an
    internal dictionary-cache error in DuckDB 2.0)."""
    text = ("(SELECT d.text FROM documents d WHERE d.doc_id = "
            "(l.l_orderkey * 7 + l.l_linenumber) % (SELECT count(*) FROM documents))"
            if with_text else "CAST(NULL AS VARCHAR)")
    return f"""
SELECT concat('B', cast(l.l_partkey AS VARCHAR)) AS asin,
       cast(1 + (cast(l.l_quantity AS INTEGER) + l.l_partkey) % 5 AS DOUBLE) AS overall,
       l.l_returnflag <> 'R' AS verified,
       {text} AS reviewText,
       concat('U', cast(o.o_custkey AS VARCHAR)) AS reviewerID,
       CASE WHEN l.l_linenumber = 7 THEN NULL ELSE o.o_orderpriority END AS summary,
       cast(epoch(l.l_shipdate) AS INTEGER) AS unixReviewTime,
       CASE WHEN l.l_returnflag = 'N' THEN NULL
            WHEN l.l_quantity >= 45 THEN concat('1,0', cast(cast(l.l_quantity AS INTEGER) AS VARCHAR))
            ELSE cast(cast(l.l_quantity AS INTEGER) AS VARCHAR) END AS vote
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
"""

