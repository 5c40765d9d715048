import numpy as np
import pytest

from plumbline.plans import order_stats
from plumbline.plans.order_stats import approximate_quantiles, quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.999, 1.0]


def expected(values):
    return np.quantile(np.array(values, dtype=float), PROBS)


@pytest.mark.parametrize("limit", [1_000_000, 3_000, 40])
def test_global_quantiles_at_every_size(spark, limit):
    rng = np.random.default_rng(7)
    a = np.concatenate([rng.lognormal(size=2_000), np.full(1_500, 3.0), [-5.0]])
    b = rng.integers(0, 4, size=a.size)
    rows = [(float(x), int(y) if i % 7 else None, None) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "a double, b int, nothing double").repartition(5)
    got = {r["column"]: r["quantiles"] for r in quantiles(df, ["a", "b", "nothing"], PROBS, rows_per_task=limit).collect()}
    np.testing.assert_allclose(got["a"], expected(a), rtol=1e-12)
    np.testing.assert_allclose(got["b"], expected([y for _, y, _ in rows if y is not None]), rtol=1e-12)
    assert got["nothing"] is None


@pytest.mark.parametrize("limit", [1_000_000, 700])
def test_grouped_quantiles_with_one_hot_group(spark, limit):
    rng = np.random.default_rng(11)
    rows = [("hot", float(x)) for x in rng.normal(size=3_000)]
    rows += [(f"g{i % 30}", float(i)) for i in range(900)]
    rows += [(None, 1.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    got = {r["g"]: r["quantiles"] for r in quantiles(df, "v", PROBS, by="g", rows_per_task=limit).collect()}
    assert set(got) == {"hot"} | {f"g{i}" for i in range(30)}
    for g, found in got.items():
        np.testing.assert_allclose(found, expected([v for k, v in rows if k == g]), rtol=1e-12)


def test_very_many_groups_are_sorted(spark, monkeypatch):
    monkeypatch.setattr(order_stats, "BROADCAST_ROWS", 4)
    rng = np.random.default_rng(12)
    rows = [("hot", float(x)) for x in rng.normal(size=2_000)]
    rows += [(f"g{i % 12}", float(x)) for i, x in enumerate(rng.normal(size=1_200))]
    rows += [("none", None)] * 3
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    got = {r["g"]: r["quantiles"] for r in quantiles(df, "v", PROBS, by="g", rows_per_task=50).collect()}
    assert got.pop("none") is None and len(got) == 13
    for g, found in got.items():
        np.testing.assert_allclose(found, expected([v for k, v in rows if k == g]), rtol=1e-12)


def test_approximate_quantiles_are_values_near_the_rank(spark):
    df = spark.range(10_001).selectExpr("cast(id as double) v")
    found = approximate_quantiles(df, "v", [0.5]).first()["quantiles"][0]
    assert abs(found - 5_000) <= 2
