"""Quantiles with endless values and clashing names, duplicates with repeated and missing keys."""

import math

import pytest
from pyspark.sql import functions as F

from plumbline.operators.charts import box_stats_by
from plumbline.operators.quality import mark_duplicates
from plumbline.plans.order_stats import quantiles


@pytest.mark.parametrize("rows_per_task", [10, 10_000])
def test_the_largest_of_endless_values(spark, rows_per_task):
    table = spark.createDataFrame([(float(i),) for i in range(200)] + [(math.inf,)], "v double").repartition(3)
    found = quantiles(table, "v", [0.0, 0.5, 1.0], rows_per_task=rows_per_task).first()["quantiles"]
    assert found == [0.0, 100.0, math.inf]


@pytest.mark.parametrize("rows_per_task", [20, 10_000])
def test_boxes_by_a_column_with_an_internal_name(spark, rows_per_task):
    rows = [(g, float(i)) for g in ("a", "b") for i in range(60)]
    table = spark.createDataFrame(rows, "value string, v double")
    found = {r["value"]: r["median"] for r in box_stats_by(table, "value", "v", rows_per_task=rows_per_task).collect()}
    assert found == {"a": 29.5, "b": 29.5}


def test_repeated_and_missing_keys_mark_one_first_row(spark):
    rows = [(1, "x", 0), (1, "x", 1), (None, "y", 2), (None, "z", 3), (4, "z", 4), (5, None, 5), (6, None, 6), (1, "w", 7)]
    table = spark.createDataFrame(rows, "k long, v string, at int").coalesce(2)
    marked = mark_duplicates(table, "k", ["v"])
    firsts = [(r["k"], r["v"]) for r in marked.where("NOT is_duplicate").collect()]
    assert sorted(firsts, key=str) == sorted([(1, "x"), (None, "y"), (4, "z"), (5, None), (1, "w")], key=str)
    assert marked.count() == len(rows) and marked.columns == ["k", "v", "at", "is_duplicate"]
    unique = mark_duplicates(table.where("at <> 1"), "k", ["v"])
    assert sorted(r["at"] for r in unique.where("is_duplicate").collect()) == [3, 6]
