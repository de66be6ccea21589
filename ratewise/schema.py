"""Schemas and write contracts of the review data."""

from pyspark.sql import types as T

REVIEW_SCHEMA = T.StructType([
    T.StructField("asin", T.StringType(), True),
    T.StructField("overall", T.DoubleType(), True),
    T.StructField("verified", T.BooleanType(), True),
    T.StructField("reviewText", T.StringType(), True),
    T.StructField("reviewerID", T.StringType(), True),
    T.StructField("summary", T.StringType(), True),
    T.StructField("unixReviewTime", T.IntegerType(), True),
    T.StructField("vote", T.StringType(), True),
])

REVIEW_COLUMNS = [f.name for f in REVIEW_SCHEMA.fields]

# Columns present in raw dumps and dropped on load.
RAW_ONLY_COLUMNS = ["reviewerName", "image", "style"]

# Write contracts: required field -> Spark type. These follow the output of each job.
LOAD_CONTRACT = {
    "asin": T.StringType(), "overall": T.DoubleType(), "reviewText": T.StringType(),
    "reviewerID": T.StringType(), "summary": T.StringType(), "unixReviewTime": T.IntegerType(),
}
CLEAN_CONTRACT = {
    "asin": T.StringType(), "overall": T.DoubleType(), "reviewText": T.StringType(),
    "reviewerID": T.StringType(), "unixReviewTime": T.IntegerType(), "feedback": T.StringType(),
}
FILTERED_CONTRACT = {
    "asin": T.StringType(), "overall": T.DoubleType(), "reviewerID": T.StringType(),
}

MESSAGE_SCHEMA = T.StructType([
    T.StructField("asin", T.ArrayType(T.StringType()), True),
    T.StructField("overall", T.ArrayType(T.DoubleType()), True),
])
