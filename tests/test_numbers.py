"""Chart aggregates, outliers, correlation and scores against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.operators import charts, correlation, metrics, outliers


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(2)
    v = np.round(rng.lognormal(1.0, 0.8, 3_000), 3)
    g = np.where(rng.random(3_000) < 0.7, "hot", "cold")
    df = spark.createDataFrame([(i, str(k), float(x)) for i, (k, x) in enumerate(zip(g, v))], "id long, g string, v double")
    return df.repartition(5).cache(), g, v


@pytest.mark.parametrize("limit", [1_000_000, 200])
def test_fences_clean_and_outliers_are_whole(skewed, limit):
    df, _, v = skewed
    q1, q3 = np.quantile(v, [0.25, 0.75])
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    row = outliers.iqr_fences(df, ["v"], rows_per_task=limit).first()
    np.testing.assert_allclose([row["low"], row["high"]], [low, high])
    clean = {r["id"] for r in outliers.iqr_clean(df, exclude=["id"], rows_per_task=limit).collect()}
    beyond = {r["id"] for r in outliers.iqr_outliers(df, ["v"], rows_per_task=limit).collect()}
    assert clean | beyond == set(range(3_000)) and not clean & beyond
    assert beyond == set(np.flatnonzero((v < low) | (v > high)))


def test_missing_value_is_neither_clean_nor_outlier(spark):
    df = spark.createDataFrame([(float(i), 1.0 if i else None) for i in range(9)], "a double, b double")
    assert outliers.iqr_clean(df).count() == 8 and outliers.iqr_outliers(df).count() == 0


def test_rare_flag_is_dropped_unless_excluded(spark):
    df = spark.range(100).selectExpr("cast(id as double) a", "cast(id = 0 as int) flag")
    assert outliers.iqr_clean(df).count() == 99
    assert outliers.iqr_clean(df, exclude=["flag"]).count() == 100


@pytest.mark.parametrize("limit", [1_000_000, 200])
def test_boxes(skewed, limit):
    df, g, v = skewed

    def box(x):
        q1, m, q3 = np.quantile(x, [0.25, 0.5, 0.75])
        inside = (x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))
        return [q1, m, q3, x[inside].min(), x[inside].max(), (~inside).sum()]

    np.testing.assert_allclose(tuple(charts.box_stats(df, ["v"], rows_per_task=limit).first())[1:], box(v))
    for r in charts.box_stats_by(df, "g", "v", rows_per_task=limit).collect():
        np.testing.assert_allclose(tuple(r)[1:], box(v[g == r["g"]]))


@pytest.mark.parametrize("bins", [1, 7, 35])
def test_histogram(skewed, bins):
    df, _, v = skewed
    rows = charts.histogram(df, "v", bins).orderBy("bin").collect()
    n, edges = np.histogram(v, bins)
    assert [r["n"] for r in rows] == list(n)
    np.testing.assert_allclose([r["left"] for r in rows] + [rows[-1]["right"]], edges)


def test_histogram_of_one_value_and_of_nothing(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "a double")
    assert [(r["left"], r["right"], r["n"]) for r in charts.histogram(df, "a").collect()] == [(2.5, 3.5, 2)]
    rows = charts.histogram(df, "a", 4).orderBy("bin").collect()
    assert [r["n"] for r in rows] == list(np.histogram([3.0, 3.0], 4)[0])
    assert charts.histogram(df.where("a > 9"), "a", 4).count() == 0


def density(x, grid):
    h = x.std(ddof=1) * len(x) ** -0.2
    return np.exp(-0.5 * ((grid[:, None] - x) / h) ** 2).sum(axis=1) / (len(x) * h * np.sqrt(2 * np.pi)), h


def test_kde(skewed):
    df, g, v = skewed
    rows = charts.kde_curve(df, "v", bins=30).orderBy("point").collect()
    grid = np.linspace(v.min(), v.max(), 200)
    want, _ = density(v, grid)
    np.testing.assert_allclose([r["x"] for r in rows], grid)
    np.testing.assert_allclose([r["density"] for r in rows], want, rtol=1e-9, atol=1e-15)  # the stated error is absolute; far from all values the density is 0
    np.testing.assert_allclose([r["frequency"] for r in rows], want * 3_000 * (v.max() - v.min()) / 30, rtol=1e-9, atol=1e-12)
    fine = charts.kde_curve(df, "v", fine_bins=5_000).orderBy("point").collect()
    np.testing.assert_allclose([r["density"] for r in fine], want, atol=1e-4)
    hued = df.withColumn("h", F.lit("x"))
    got = charts.violin_by_hue(hued, "g", "v", "h", points=50).where("g = 'cold'").orderBy("point").collect()
    x = v[g == "cold"]
    h = density(x, x[:1])[1]
    grid = np.linspace(x.min() - 2 * h, x.max() + 2 * h, 50)
    np.testing.assert_allclose([r["y"] for r in got], grid)
    np.testing.assert_allclose([r["density"] for r in got], density(x, grid)[0], rtol=1e-9)
    np.testing.assert_allclose([got[0]["q1"], got[0]["median"], got[0]["q3"]], np.quantile(x, [0.25, 0.5, 0.75]))


def test_flat_group_has_no_curve(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0), ("b", 1.0), ("b", 2.0)], "g string, v double")
    assert {r["g"] for r in charts.kde_curve(df, "v", by="g", points=5).collect()} == {"b"}
    assert charts.kde_curve(df.where("g = 'a'"), "v", points=5).count() == 0


def test_correlation_is_pairwise_and_survives_constants(spark):
    rng = np.random.default_rng(4)
    a, b = rng.normal(size=200), rng.normal(size=200)
    b += a
    rows = [(float(x), float(y) if i % 5 else None, 7.0) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "a double, b double, k double")
    got = {(r["col_x"], r["col_y"]): r["corr"] for r in correlation.correlation_matrix(df).collect()}
    keep = np.arange(200) % 5 != 0
    assert got["a", "b"] == got["b", "a"] == pytest.approx(np.corrcoef(a[keep], b[keep])[0, 1])
    assert got["a", "a"] == pytest.approx(1) and got["a", "k"] is None and got["k", "k"] is None
    full = {(r["col_x"], r["col_y"]): r["corr"] for r in correlation.correlation_matrix(df.dropna(), ["a", "b"], "matrix").collect()}
    assert full["a", "b"] == pytest.approx(got["a", "b"])
    assert [r["column"] for r in correlation.target_correlation(df, "b").collect()] == ["a", "k"]


def scored(spark, n=2_000, hot=0.4):
    rng = np.random.default_rng(9)
    y = rng.integers(0, 2, n)
    s = np.round(rng.normal(size=n) + y, 2)
    s[rng.random(n) < hot] = 0.5
    return spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double"), y, s


@pytest.mark.parametrize("limit", [1_000_000, 300, 20])
def test_roc_and_auc(spark, limit):
    df, y, s = scored(spark)
    wins = (s[y == 1][:, None] > s[y == 0]).mean() + 0.5 * (s[y == 1][:, None] == s[y == 0]).mean()
    assert metrics.roc_auc(df, rows_per_task=limit).first()["auc"] == pytest.approx(wins)
    minus = df.withColumn("score", -F.col("score"))
    assert metrics.roc_auc(minus, rows_per_task=limit).first()["auc"] == pytest.approx(1 - wins)
    curve = metrics.roc_curve(df, rows_per_task=limit)
    assert metrics.auc_trapezoid(curve).first()["auc"] == pytest.approx(wins)
    cuts = np.unique(s)[::-1]
    want = [(0.0, 0.0)] + [((s[y == 0] >= c).mean(), (s[y == 1] >= c).mean()) for c in cuts]
    rows = sorted(curve.collect(), key=lambda r: -np.inf if r["threshold"] is None else -r["threshold"])
    np.testing.assert_allclose([(r["fpr"], r["tpr"]) for r in rows], want)
    turns = metrics.roc_curve(df, drop_intermediate=True, rows_per_task=limit).collect()
    fps = np.array([((s == c) & (y == 0)).sum() for c in cuts]).cumsum()
    tps = np.array([((s == c) & (y == 1)).sum() for c in cuts]).cumsum()
    kept = np.r_[True, np.logical_or(np.diff(fps, 2), np.diff(tps, 2)), True]
    assert {r["threshold"] for r in turns} == {None} | set(cuts[kept])


def test_auc_without_a_class_is_missing(spark):
    df = spark.createDataFrame([(1, 0.3), (1, 0.4)], "label int, score double")
    assert metrics.roc_auc(df).first()["auc"] is None
    assert metrics.auc_trapezoid(metrics.roc_curve(df)).first()["auc"] is None


def test_scores_of_predictions(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 1), (1, 1), (1, None)], "label int, prediction int")
    row = metrics.classification_metrics(df).first()
    assert row["accuracy"] == pytest.approx(0.6) and row["recall"] == pytest.approx(2 / 3)
    assert metrics.classification_metrics(df.where("label = 0")).first()["recall"] is None
    numbers = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 2.0)], "label double, prediction double")
    row = metrics.regression_metrics(numbers).first()
    assert (row["mae"], row["mse"]) == (pytest.approx(4 / 3), pytest.approx(10 / 3))
    assert row["r2"] == pytest.approx(1 - 10 / 8)
