"""Kernel sums, bootstrap vectors and bins against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.operators import charts, tabulate


def plain_density(x, points=200, cut=0.0):
    h = x.std(ddof=1) * len(x) ** -0.2
    grid = np.linspace(x.min() - cut * h, x.max() + cut * h, points)
    return grid, np.exp(-0.5 * ((grid[:, None] - x) / h) ** 2).sum(1) / (len(x) * h * np.sqrt(2 * np.pi))


@pytest.mark.parametrize("shape", ["normal", "heavy", "few"])
def test_density_is_the_kernel_sum(spark, shape):
    rng = np.random.default_rng(1)
    x = {"normal": rng.normal(3, 2, 3000), "heavy": rng.standard_cauchy(2000) * 5, "few": rng.integers(0, 4, 1500) * 1.0}[shape]
    table = spark.createDataFrame([(float(v),) for v in x], "v double").repartition(5)
    rows = charts.kde_curve(table, "v", cut=1.5).orderBy("point").collect()
    grid, want = plain_density(x, cut=1.5)
    assert [r["point"] for r in rows] == list(range(200))
    np.testing.assert_allclose([r["x"] for r in rows], grid, atol=1e-9 * np.abs(grid).max())
    h = x.std(ddof=1) * len(x) ** -0.2
    assert np.abs(np.array([r["density"] for r in rows]) - want).max() * h * np.sqrt(2 * np.pi) < 1e-10


def test_density_by_columns_with_the_operators_own_names(spark):
    rows = [("a", float(i), 1) for i in range(5)] + [("b", float(i * i), 2) for i in range(5)] + [(None, 1.0, 1), ("c", 7.0, 1)]
    table = spark.createDataFrame(rows, "point string, v double, __cell int")
    found = charts.kde_curve(table, "v", by="point", points=15)
    assert found.columns == ["point", "point", "x", "density"] and found.count() == 30
    assert charts.kde_curve(table, "v", by=["__cell"], points=15).count() == 30


def test_shuffled_rows_grow_with_cells_not_with_values(spark):
    rng = np.random.default_rng(5)
    table = spark.createDataFrame([(float(v),) for v in rng.normal(size=4000)], "v double")
    plan = charts.kde_curve(table, "v")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 2  # cells to their grid points, and the grid itself


def test_bins_of_a_wide_range(spark):
    table = spark.createDataFrame([(0.0,), (1.0,), (3e6,)], "v double")
    found = charts.histogram(table, "v", width_target=3.0)
    assert found.count() == 1_000_000
    assert [(r["bin"], r["n"]) for r in found.where("n > 0").orderBy("bin").collect()] == [(0, 2), (999_999, 1)]


def test_poisson_cuts():
    cuts = tabulate.poisson_cuts()
    assert len(cuts) == 12 and abs(cuts[0] - np.exp(-1)) < 1e-15 and 1 - cuts[-1] < 1e-8


def test_bootstrap_adds_vectors(spark):
    rng = np.random.default_rng(7)
    rows = [(g, i, float(rng.normal(10 * k, 1 + k))) for k, g in enumerate("ab") for i in range(400)]
    table = spark.createDataFrame(rows, "g string, id long, v double")
    made = tabulate.group_mean_bootstrap(table, "g", "v", "id", replicates=250, blocks=100_000)
    assert "Generate explode" not in made._jdf.queryExecution().optimizedPlan().toString()
    for r in made.collect():
        v = np.array([x for g, _, x in rows if g == r["g"]])
        half = 1.96 * v.std(ddof=1) / 20
        assert abs(r["mean"] - v.mean()) < 1e-9
        assert 0.75 < (r["mean"] - r["low"]) / half < 1.3 and 0.75 < (r["high"] - r["mean"]) / half < 1.3


def test_groups_draw_their_own_weights(spark):
    """Two groups with the same values and keys do not share their replicates."""
    table = spark.range(300).select("id", F.col("id").cast("double").alias("v"), F.explode(F.array(F.lit("a"), F.lit("b"))).alias("g"))
    low = {r["g"]: r["low"] for r in tabulate.group_mean_bootstrap(table, "g", "v", "id", replicates=60).collect()}
    assert low["a"] != low["b"]
