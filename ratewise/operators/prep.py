"""Row-level cleaning: projections, predicates, fills and labels.

All are column expressions (whole-stage codegen); scalars such as a global mean are computed
as scalar subqueries, so no value is pulled through the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, BooleanType

from ..session import stored

# Fixed value: 2013-01-01 00:00:00 UTC, the reference's cut-off for recent reviews.
SINCE_2013 = 1356998400


def drop_incomplete(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Drop a row if any (of the named) column is null."""
    return df.dropna(how="any", subset=subset)


def incomplete_rows(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Rows with a null in any of the named columns."""
    cols = cols or df.columns
    return df.where(reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols]))


def only_verified(df: DataFrame) -> DataFrame:
    """``verified == True``; null is dropped."""
    return df.where(F.col("verified"))


def since(df: DataFrame, ts: int = SINCE_2013, col: str = "unixReviewTime") -> DataFrame:
    """Reviews at or after epoch second ``ts`` (pushed to the Parquet scan)."""
    return df.where(F.col(col) >= F.lit(ts))


def min_text_length(df: DataFrame, n: int = 5, col: str = "reviewText") -> DataFrame:
    """P5: at least ``n`` characters (blanks count)."""
    return df.where(F.length(col) >= n)


def merge_summary(df: DataFrame, text: str = "reviewText", summary: str = "summary") -> DataFrame:
    """``text + ' ' + summary``; a null part is skipped (no stray blank); summary dropped."""
    return df.withColumn(text, F.concat_ws(" ", F.col(text), F.col(summary))).drop(summary)


def fill_text(df: DataFrame, cols: tuple[str, ...] = ("reviewText", "summary")) -> DataFrame:
    """Null text becomes ''."""
    return df.fillna("", subset=[c for c in cols if c in df.columns])


def label_feedback(df: DataFrame, rating: str = "overall", out: str = "feedback") -> DataFrame:
    """P10: ``good`` when rating >= 3, else ``bad`` (null rating -> bad)."""
    return df.withColumn(out, F.when(F.col(rating) >= 3, "good").otherwise("bad"))


def vote_number(col: str = "vote", strict: bool = False):
    """Column: the vote text as a double, null when it is not a number.

    ``strict=True`` follows the reference and turns "1,234" into null; the default reads the
    thousands separator."""
    c = F.col(col)
    if not strict:
        c = F.regexp_replace(c, ",", "")
    return c.try_cast("double")


def parse_vote(df: DataFrame, col: str = "vote", strict: bool = False) -> DataFrame:
    """String vote -> double, bad -> null."""
    return df.withColumn(col, vote_number(col, strict))


def fill_vote_global(df: DataFrame, col: str = "vote") -> DataFrame:
    """Null vote -> round(mean(vote), 2) over the whole table (scalar subquery)."""
    parsed = df.withColumn(col, vote_number(col))
    mean = parsed.select(F.round(F.avg(col), 2)).scalar()
    return parsed.withColumn(col, F.coalesce(F.col(col), mean))


def back_fill(df: DataFrame, col: str, order: list[str]) -> DataFrame:
    """``df`` with a null ``col`` taking the next value that is not null, in ascending ``order`` (columns
    that tell rows apart, as file and position); what comes after the last value stays null.

    Rows are range-partitioned by the order and stored once. Inside a partition the value is carried
    back by one pass over a descending sort; between partitions the first value of each goes to the
    partitions before it that end without one: a table of one row per partition."""
    spread = stored(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()), "spread")
    down = [F.desc(c) for c in order]
    back = Window.partitionBy("_part").orderBy(*down).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = spread.withColumn("_next", F.last(col, ignorenulls=True).over(back))
    ahead = F.min_by(F.col(col), F.struct(*order)).alias("_first")
    # the first value of each partition, then the nearest one of the later partitions
    firsts = (spread.select("_part").distinct()
              .join(spread.where(F.col(col).isNotNull()).groupBy("_part").agg(ahead), "_part", "left"))
    later = Window.orderBy(F.desc("_part")).rowsBetween(Window.unboundedPreceding, -1)
    firsts = firsts.select("_part", F.last("_first", ignorenulls=True).over(later).alias("_carry"))
    return (inside.join(F.broadcast(firsts), "_part")  # one row per partition
            .withColumn(col, F.coalesce("_next", "_carry")).drop("_part", "_next", "_carry"))


def fill_vote_by_product(df: DataFrame, col: str = "vote", key: str = "asin",
                         to_int: bool = True, order: list[str] | None = None) -> DataFrame:
    """Null vote -> mean vote of the same product; products without any vote take the next vote
    in file order if ``order`` names the columns that give it (file and position; see
    :func:`back_fill`), and what is then left the global mean.

    The per-product mean is an aggregate joined back on the key rather than a window, so a
    product holding a large share of all rows is pre-aggregated map-side and never sorted in
    one task; AQE splits the skewed join partition."""
    parsed = df.withColumn(col, vote_number(col))
    means = parsed.groupBy(key).agg(F.avg(col).alias("_key_mean"))
    overall_mean = parsed.select(F.avg(col)).scalar()
    out = parsed.join(means, key, "left").withColumn(col, F.coalesce(F.col(col), F.col("_key_mean"))).drop("_key_mean")
    if order:
        out = back_fill(out, col, order).select(*parsed.columns)
    out = out.withColumn(col, F.coalesce(F.col(col), overall_mean))
    if to_int:
        out = out.withColumn(col, F.col(col).cast("int"))
    return out


def history_of(df: DataFrame, user: str, col: str = "reviewerID") -> DataFrame:
    """The rows of one user."""
    return df.where(F.col(col) == F.lit(user))


def to_float32(df: DataFrame, col: str = "overall") -> DataFrame:
    """P16."""
    return df.withColumn(col, F.col(col).cast("float"))


def minmax_scale(df: DataFrame, col: str = "overall", out: str = "y") -> DataFrame:
    """``(x - min) / (max - min)``; null when max = min."""
    lo = df.select(F.min(col)).scalar()
    hi = df.select(F.max(col)).scalar()
    x = F.col(col).cast("double")
    return df.withColumn(out, F.try_divide(x - lo, hi - lo))


def numeric_columns(df: DataFrame, max_columns: int = 10) -> DataFrame:
    """Which numeric columns (booleans are not) qualify for the scatter matrix: no nulls and
    more than one distinct value, i.e. a minimum below the maximum; the first ``max_columns`` in
    schema order are kept.

    Returns one row per numeric column: (position, column, nulls, varies, keep), in one pass."""
    fields = [f for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    if not fields:
        return df.sparkSession.createDataFrame([], "position int, column string, nulls bigint, "
                                                   "varies boolean, keep boolean")
    aggs = []
    for i, f in enumerate(fields):
        aggs += [F.count_if(F.col(f.name).isNull()).alias(f"n{i}"),
                 F.coalesce(F.min(f.name) < F.max(f.name), F.lit(False)).alias(f"v{i}")]
    rows = F.array(*[F.struct(F.lit(i + 1).alias("position"), F.lit(f.name).alias("column"),
                              F.col(f"n{i}").alias("nulls"), F.col(f"v{i}").alias("varies"))
                     for i, f in enumerate(fields)])
    out = df.agg(*aggs).select(F.inline(rows))
    eligible = (F.col("nulls") == 0) & F.col("varies")
    # running count of eligible columns over at most len(schema) rows: bounded, one partition
    from pyspark.sql import Window
    w = Window.orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    ordinal = F.sum(eligible.cast("int")).over(w)
    return out.withColumn("keep", eligible & (ordinal <= max_columns))
