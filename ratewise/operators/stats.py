"""Profiling aggregates (counts, moments, histograms, densities, correlations) and top-k.

Each returns a small DataFrame. Wide one-row aggregates are unpivoted into long form with
``inline(array(struct ...))`` so results have a fixed schema whatever the column list.
Table-wide scalars (min, max, std) are scalar subqueries; Spark merges those that read the same
plan (MergeScalarSubqueries), so they cost one extra aggregate pass, not one per scalar.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

from ..session import cut_lineage


def _num(col: str):
    return F.col(col).cast("double")


def row_count(df: DataFrame) -> DataFrame:
    """A1."""
    return df.agg(F.count(F.lit(1)).alias("rows"))


def table_shape(df: DataFrame) -> DataFrame:
    """A10: rows x columns."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("columns"))


def _unpivot(one_row: DataFrame, structs) -> DataFrame:
    return one_row.select(F.inline(F.array(*structs)))


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column, long form (position, column, nulls)."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(df.columns)])
    return _unpivot(row, [F.struct(F.lit(i + 1).alias("position"), F.lit(c).alias("column"),
                                   F.col(f"_{i}").alias("nulls")) for i, c in enumerate(df.columns)])


def table_info(df: DataFrame) -> DataFrame:
    """Columns, types and non-null counts."""
    row = df.agg(*[F.count(F.col(f.name)).alias(f"_{i}") for i, f in enumerate(df.schema.fields)])
    return _unpivot(row, [F.struct(F.lit(i + 1).alias("position"), F.lit(f.name).alias("column"),
                                   F.lit(f.dataType.simpleString()).alias("dtype"),
                                   F.col(f"_{i}").alias("non_null"))
                          for i, f in enumerate(df.schema.fields)])


def numeric_column_names(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (NumericType, BooleanType))]


QUARTILES = (0.25, 0.5, 0.75)


def exact_quantiles(df: DataFrame, cols: list[str], qs=QUARTILES) -> DataFrame:
    """(column, q, value): quantiles with linear interpolation (as pandas) of the non-null values.

    Distinct values are counted with a partial aggregate, range-partitioned by (column, value) and
    materialised; a running count within each partition plus the column's count in all earlier
    partitions gives every value its positions. No task holds a column's values."""
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), _num(c).alias("x")) for i, c in enumerate(cols)])
    counts = (df.select(F.inline(pairs)).where(F.col("x").isNotNull())
              .groupBy("i", "x").agg(F.count(F.lit(1)).alias("c")))
    placed = cut_lineage(counts.repartitionByRange("i", "x").sortWithinPartitions("i", "x")
                         .withColumn("p", F.spark_partition_id()))
    # one row per partition and column
    part = placed.groupBy("i", "p").agg(F.sum("c").alias("n"))
    earlier = Window.partitionBy("i").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy("i")
    part = part.select("i", "p", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
                       F.sum("n").over(every).alias("total"))
    running = Window.partitionBy("p", "i").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = (placed.withColumn("upto", F.sum("c").over(running)).join(part, ["i", "p"])
          .select("i", "x", "total", (F.col("before") + F.col("upto") - F.col("c")).alias("first"),
                  (F.col("before") + F.col("upto") - 1).alias("last")))
    wanted = F.array(*[F.lit(float(q)) for q in qs])
    h = (F.col("total") - 1) * F.col("q")
    low, high = F.floor(h), F.ceil(h)
    at = at.select("*", F.explode(wanted).alias("q"))
    hit = at.select("i", "q", "x", (h - low).alias("f"), ((F.col("first") <= low) & (low <= F.col("last"))).alias("lo"),
                    ((F.col("first") <= high) & (high <= F.col("last"))).alias("hi")).where("lo OR hi")
    got = hit.groupBy("i", "q").agg(F.max(F.when(F.col("lo"), F.col("x"))).alias("a"),
                                    F.max(F.when(F.col("hi"), F.col("x"))).alias("b"), F.max("f").alias("f"))
    names = F.array(*[F.lit(c) for c in cols])
    return got.select(F.get(names, F.col("i")).alias("column"), "q",
                      (F.col("a") + (F.col("b") - F.col("a")) * F.col("f")).alias("value"))


def describe_numeric(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Count, mean, std, min, quartiles (exact), max per numeric column; booleans are no numbers
    here (they are for A19)."""
    cols = cols or [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
    aggs = []
    for i, c in enumerate(cols):
        x = _num(c)
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
    rows = _unpivot(df.agg(*aggs), [F.struct(
        F.lit(c).alias("column"), F.col(f"n{i}").alias("count"), F.col(f"m{i}").alias("mean"),
        F.col(f"s{i}").alias("std"), F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"))
        for i, c in enumerate(cols)])
    pick = lambda q: F.max(F.when(F.col("q") == q, F.col("value")))
    quartiles = exact_quantiles(df, cols).groupBy("column").agg(
        *[pick(q).alias(name) for q, name in zip(QUARTILES, ("p25", "p50", "p75"))])
    return (rows.join(quartiles, "column", "left")
            .select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max"))


def mean_rating(df: DataFrame, col: str = "overall") -> DataFrame:
    """round(mean, 2)."""
    return df.agg(F.round(F.avg(col), 2).alias("mean_rating"))


def rating_range(df: DataFrame, col: str = "overall") -> DataFrame:
    """A13."""
    return df.agg(F.min(col).alias("min_rating"), F.max(col).alias("max_rating"))


def mean_vote(df: DataFrame, col: str = "vote") -> DataFrame:
    """On the parsed vote."""
    from .prep import vote_number
    return df.agg(F.round(F.avg(vote_number(col)), 2).alias("mean_vote"))


def reviews_per_product(df: DataFrame) -> DataFrame:
    """A4: ``count(reviewerID)`` per asin."""
    return df.groupBy("asin").agg(F.count("reviewerID").alias("n_reviews"))


def reviews_per_product_rating(df: DataFrame) -> DataFrame:
    """A5: per (asin, overall)."""
    return df.groupBy("asin", "overall").agg(F.count("reviewerID").alias("n_reviews"))


def distinct_counts(df: DataFrame, approx: bool = False) -> DataFrame:
    """Distinct reviewers and products."""
    f = (lambda c: F.approx_count_distinct(c)) if approx else (lambda c: F.count_distinct(c))
    return df.agg(f("reviewerID").alias("n_reviewers"), f("asin").alias("n_products"))


def feedback_counts(df: DataFrame, col: str = "feedback") -> DataFrame:
    """Number of good and bad reviews."""
    return df.agg(F.count_if(F.col(col) == "good").alias("good"),
                  F.count_if(F.col(col) == "bad").alias("bad"))


def value_counts_top(df: DataFrame, col: str = "asin", k: int = 10) -> DataFrame:
    """The ``k`` most frequent values (ties by value); partial aggregate, then
    ``TakeOrderedAndProject``."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), F.asc(col)).limit(k))


def category_counts(df: DataFrame, col: str = "verified") -> DataFrame:
    """A16."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def _value_counts(df: DataFrame, value) -> DataFrame:
    """(x, c): distinct non-null values with their counts, materialised. Histogram and density read
    this table several times, so the source - e.g. a tokenised text - is scanned once."""
    x = value if not isinstance(value, str) else _num(value)
    return cut_lineage(df.select(x.alias("x")).where(F.col("x").isNotNull())
                       .groupBy("x").agg(F.count(F.lit(1)).alias("c")))


def histogram(df: DataFrame, value, bins: int = 10) -> DataFrame:
    """Equal-width bins between min and max; the maximum falls into the last bin.
    Returns every bin, empty ones with n = 0: (bin, lower, upper, n)."""
    d = _value_counts(df, value)
    lo = d.select(F.min("x")).scalar()
    hi = d.select(F.max("x")).scalar()
    width = hi - lo
    bucket = F.when(width == 0, F.lit(1)).otherwise(
        F.least(F.floor(F.lit(float(bins)) * (F.col("x") - lo) / width) + 1, F.lit(bins))).cast("int")
    counts = d.groupBy(bucket.alias("bin")).agg(F.sum("c").alias("n"))
    edges = df.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return (edges.join(counts, "bin", "left")
            .select("bin",
                    F.round(lo + (F.col("bin") - 1) * width / bins, 6).alias("lower"),
                    F.round(lo + F.col("bin") * width / bins, 6).alias("upper"),
                    F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n")))


def kde(df: DataFrame, value, grid: int = 200, cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density on ``grid`` points from ``min - cut*h`` to ``max + cut*h``,
    Scott's bandwidth ``h = std * n^(-1/5)``.

    A constant or one-row column has no spread and gives null densities; a column without values
    gives no rows. Work is (distinct values) x grid: values are pre-aggregated to (x, count) first (one scan
    of the source), the moments come from that table, then each distinct value emits its
    contribution to every grid point, summed per point."""
    d = _value_counts(df, value)
    n = d.select(F.sum("c")).scalar()
    mean = d.select(F.sum(F.col("c") * F.col("x")) / F.sum("c")).scalar()
    std = d.select(F.sqrt(F.try_divide(F.sum(F.col("c") * F.pow(F.col("x") - mean, 2)), F.sum("c") - 1))).scalar()
    lo = d.select(F.min("x")).scalar()
    hi = d.select(F.max("x")).scalar()
    h = std * F.pow(n, F.lit(-0.2))
    start = lo - F.lit(cut) * h
    step = (hi - lo + F.lit(2 * cut) * h) / F.lit(grid - 1)
    # each distinct value fans out to every grid point: spread the (small) table first
    pts = d.repartition("x").select("x", "c", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("point"))
    g = start + F.col("point") * step
    contrib = F.col("c") * F.exp(-0.5 * F.pow(F.try_divide(g - F.col("x"), h), 2))
    norm = n * h * F.lit(math.sqrt(2 * math.pi))
    return (pts.groupBy("point").agg(F.sum(contrib).alias("s"))
            .select(F.col("point").cast("int").alias("point"), F.round(start + F.col("point") * step, 6).alias("x"),
                    F.round(F.try_divide(F.col("s"), norm), 6).alias("density")))


def kde_binned(df: DataFrame, value, grid: int = 200, cut: float = 3.0, cells: int = 4096, reach: float = 8.0) -> DataFrame:
    """A18 for continuous columns: as :func:`kde`, but the rows do not grow with the distinct values.

    Each value is shared between the two nearest of ``cells`` + 1 equally spaced points (linear
    binning) in one aggregate; the points then emit to the grid points within ``reach`` bandwidths.
    With cells of width d the density is off by at most 0.4 * d**2 / (8 * h**3) for the binning and
    exp(-reach**2 / 2) / h for the cut tail (see :func:`kde_binned_error`)."""
    x = value if not isinstance(value, str) else _num(value)
    src = df.select(x.cast("double").alias("x")).where(F.col("x").isNotNull())
    # one pass for the moments, one for the cells
    m = cut_lineage(src.agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("x").alias("std"), F.min("x").alias("lo"), F.max("x").alias("hi")))
    n, std, lo, hi = (m.select(c).scalar() for c in ("n", "std", "lo", "hi"))
    width = (hi - lo) / F.lit(float(cells))
    at = F.try_divide(F.col("x") - lo, width)
    cell = F.least(F.floor(at), F.lit(cells - 1)).cast("int")
    share = src.select(cell.alias("cell"), (at - cell).alias("f")).groupBy("cell").agg(F.count(F.lit(1)).alias("c"), F.sum("f").alias("s"))
    parts = F.array(F.struct(F.col("cell").alias("cell"), (F.col("c") - F.col("s")).alias("w")), F.struct((F.col("cell") + 1).alias("cell"), F.col("s").alias("w")))
    masses = cut_lineage(share.where("cell IS NOT NULL").select(F.inline(parts)).groupBy("cell").agg(F.sum("w").alias("w")))  # at most cells + 1 rows
    h = std * F.pow(F.greatest(n, F.lit(1)), F.lit(-0.2))
    start = lo - F.lit(cut) * h
    step = (hi - lo + F.lit(2 * cut) * h) / F.lit(grid - 1)
    center = lo + F.col("cell") * width
    first = F.greatest(F.ceil(F.try_divide(center - F.lit(reach) * h - start, step)), F.lit(0)).cast("int")
    last = F.least(F.floor(F.try_divide(center + F.lit(reach) * h - start, step)), F.lit(grid - 1)).cast("int")
    pts = masses.select(center.alias("x"), "w", F.explode(F.sequence(first, last)).alias("point"))
    contrib = F.col("w") * F.exp(-0.5 * F.pow(F.try_divide(start + F.col("point") * step - F.col("x"), h), 2))
    sums = pts.groupBy("point").agg(F.sum(contrib).alias("s"))
    every = df.sparkSession.range(grid).select(F.col("id").cast("int").alias("point")).where(n > 0)
    out = every.join(sums, "point", "left")
    density = F.when(h > 0, F.try_divide(F.coalesce("s", F.lit(0.0)), n * h * F.lit(math.sqrt(2 * math.pi))))
    return out.select("point", F.round(start + F.col("point") * step, 6).alias("x"), density.alias("density"))


def kde_binned_error(h: float, spread: float, cells: int = 4096, reach: float = 8.0) -> float:
    """How far :func:`kde_binned` can be from :func:`kde` for bandwidth ``h`` and max - min ``spread``."""
    return 0.4 * (spread / cells) ** 2 / (8 * h ** 3) + math.exp(-reach ** 2 / 2) / h


def correlation_matrix(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Pearson correlation for each pair of numeric/boolean columns (pairwise complete
    rows), one aggregate pass, long form (col_a, col_b, corr) for a before b."""
    cols = cols or numeric_column_names(df)
    pairs = list(combinations(range(len(cols)), 2))
    row = df.agg(*[F.corr(_num(cols[i]), _num(cols[j])).alias(f"c{i}_{j}") for i, j in pairs])
    return _unpivot(row, [F.struct(F.lit(cols[i]).alias("col_a"), F.lit(cols[j]).alias("col_b"),
                                   F.round(F.col(f"c{i}_{j}"), 6).alias("corr")) for i, j in pairs])


def scatter_bins(df: DataFrame, cols: list[str], bins: int = 10) -> DataFrame:
    """A20, off the diagonal: 2-D equal-width bin counts for each pair of columns. One pass: each
    row emits one (pair, bin, bin) cell per pair, counted with a partial aggregate."""
    b = {}
    for c in cols:
        x = _num(c)
        lo = df.select(F.min(x)).scalar()
        hi = df.select(F.max(x)).scalar()
        b[c] = F.when(hi == lo, F.lit(1)).otherwise(
            F.least(F.floor(F.lit(float(bins)) * (x - lo) / (hi - lo)) + 1, F.lit(bins))).cast("int")
    cells = F.array(*[F.struct(F.lit(a).alias("col_a"), F.lit(c).alias("col_b"),
                               b[a].alias("bin_a"), b[c].alias("bin_b"))
                      for a, c in combinations(cols, 2)])
    return (df.select(F.inline(cells)).where(F.col("bin_a").isNotNull() & F.col("bin_b").isNotNull())
            .groupBy("col_a", "col_b", "bin_a", "bin_b").agg(F.count(F.lit(1)).alias("n")))


def scatter_columns(df: DataFrame, max_columns: int = 10) -> list[str]:
    """The columns that P18 keeps (at most ``max_columns`` names)."""
    from .prep import numeric_columns
    return [r["column"] for r in numeric_columns(df, max_columns).where("keep").orderBy("position").collect()]


def scatter_matrix(df: DataFrame, bins: int = 10, grid: int = 50, max_columns: int = 10) -> dict[str, DataFrame]:
    """The scatter matrix of the columns that P18 keeps, as tables: ``cells`` (pair, bin, bin,
    n, and the pair's correlation beside it) and ``diagonal`` (column, point, x, density)."""
    cols = scatter_columns(df, max_columns)
    if not cols:
        empty = df.sparkSession.createDataFrame
        return {"cells": empty([], "col_a string, col_b string, bin_a int, bin_b int, n bigint, corr double"),
                "diagonal": empty([], "column string, point int, x double, density double")}
    diagonal = [kde(df, c, grid).select(F.lit(c).alias("column"), "point", "x", "density") for c in cols]
    if len(cols) == 1:
        cells = df.sparkSession.createDataFrame([], "col_a string, col_b string, bin_a int, bin_b int, n bigint, corr double")
    else:
        # one row per pair of at most max_columns columns
        cells = scatter_bins(df, cols, bins).join(F.broadcast(correlation_matrix(df, cols)), ["col_a", "col_b"])
    return {"cells": cells, "diagonal": reduce(lambda x, y: x.unionByName(y), diagonal)}


RATED_ORDER = ("asin", "reviewerID", "unixReviewTime")


def best_rated(df: DataFrame, n: int = 10, ascending: bool = False,
               cols: tuple[str, ...] = ("asin", "reviewerID", "overall", "unixReviewTime"),
               by_product: bool = False, min_reviews: int = 3) -> DataFrame:
    """K1: the first ``n`` review rows by rating (desc), ties by asin, reviewer, time. With
    ``by_product`` the first ``n`` products with ``min_reviews`` ratings or more by mean rating,
    ties by number of ratings (desc), asin: (asin, mean_rating, n_reviews)."""
    way = F.asc if ascending else F.desc
    if by_product:
        means = df.groupBy("asin").agg(F.avg("overall").alias("mean_rating"), F.count("overall").alias("n_reviews"))
        return (means.where(F.col("n_reviews") >= min_reviews)
                .orderBy(way("mean_rating"), F.desc("n_reviews"), F.asc("asin")).limit(n))
    return df.select(*cols).orderBy(way("overall"), *[F.asc(c) for c in RATED_ORDER]).limit(n)


def worst_rated(df: DataFrame, n: int = 10, **options) -> DataFrame:
    """K1: ascending."""
    return best_rated(df, n, ascending=True, **options)


def top_k_per_group(df: DataFrame, group: list[str], order: list, k: int,
                    rank_col: str = "rank") -> DataFrame:
    """K3: the first ``k`` rows per group. ``row_number() <= k`` is planned as a partial
    WindowGroupLimit before the shuffle, so at most k rows per group and map task move."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)
