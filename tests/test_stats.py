import math

import numpy as np

from ratewise.operators import stats


def test_histogram_max_in_last_bin(spark):
    df = spark.createDataFrame([(float(x),) for x in [1, 2, 2, 3, 5]], "x double")
    h = {r.bin: r.n for r in stats.histogram(df, "x", 4).collect()}
    assert h == {1: 1, 2: 2, 3: 1, 4: 1}


def test_histogram_constant(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    h = {r.bin: r.n for r in stats.histogram(df, "x", 3).collect()}
    assert h == {1: 2, 2: 0, 3: 0}


def test_kde_integrates_to_one(spark):
    xs = [1.0, 2.0, 2.0, 3.0, 4.0, 4.5, 5.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    pts = sorted((r.x, r.density) for r in stats.kde(df, "x", 400).collect())
    area = sum((pts[i + 1][0] - pts[i][0]) * (pts[i][1] + pts[i + 1][1]) / 2 for i in range(len(pts) - 1))
    assert abs(area - 1) < 0.01
    h = np.std(xs, ddof=1) * len(xs) ** -0.2
    g = pts[200][0]
    want = sum(math.exp(-0.5 * ((g - x) / h) ** 2) for x in xs) / (len(xs) * h * math.sqrt(2 * math.pi))
    assert abs(pts[200][1] - want) < 1e-5


def test_correlation_and_describe(spark):
    rng = np.random.default_rng(1)
    a = rng.normal(size=50)
    b = 2 * a + rng.normal(size=50)
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "a double, b double")
    c = stats.correlation_matrix(df).first()
    assert abs(c.corr - np.corrcoef(a, b)[0, 1]) < 1e-6
    d = {r.column: r for r in stats.describe_numeric(df).collect()}
    assert abs(d["a"].p25 - np.quantile(a, 0.25)) < 1e-9 and abs(d["a"].std - np.std(a, ddof=1)) < 1e-9


def test_best_worst(spark):
    df = spark.createDataFrame([("B2", "U1", 5.0, 1), ("B1", "U2", 5.0, 1), ("B3", "U1", 1.0, 1)],
                               "asin string, reviewerID string, overall double, unixReviewTime int")
    assert [r.asin for r in stats.best_rated(df, 2).collect()] == ["B1", "B2"]
    assert [r.asin for r in stats.worst_rated(df, 1).collect()] == ["B3"]


def test_kde_without_spread_is_null(spark):
    for rows in ([(3.0,)] * 5, [(3.0,)]):
        out = stats.kde(spark.createDataFrame(rows, "x double"), "x", 10).collect()
        assert len(out) == 10 and all(r.density is None for r in out)
    assert stats.kde(spark.createDataFrame([(None,)], "x double"), "x", 10).count() == 0


def test_quantiles_with_ties_nulls_and_empty_columns(spark):
    xs = [1.0] * 40 + [2.0, 5.0, None, 7.5, None, 9.0, 9.0]
    df = spark.createDataFrame([(x, None) for x in xs], "x double, y double")
    d = {r.column: r for r in stats.describe_numeric(df, ["x", "y"]).collect()}
    known = [x for x in xs if x is not None]
    assert (d["x"].p25, d["x"].p50, d["x"].p75) == tuple(np.quantile(known, [0.25, 0.5, 0.75]))
    assert d["y"]["count"] == 0 and d["y"].p50 is None
    q = {(r.column, r.q): r.value for r in stats.exact_quantiles(df, ["x"], (0.9, 0.99)).collect()}
    assert abs(q["x", 0.9] - np.quantile(known, 0.9)) < 1e-12 and abs(q["x", 0.99] - np.quantile(known, 0.99)) < 1e-12
