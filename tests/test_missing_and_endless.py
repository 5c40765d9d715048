"""Missing and repeated keys, and values without end."""

import math

import pytest

from plumbline.operators.quality import drop_duplicates
from plumbline.operators.select import attach_predictions
from plumbline.operators.split import add_folds, train_test_split
from plumbline.plans.order_stats import quantiles


@pytest.mark.parametrize("odd", [math.inf, -math.inf, math.nan])
@pytest.mark.parametrize("by", [[], ["g"]])
def test_narrowing_ends_with_an_endless_value(spark, odd, by):
    df = spark.createDataFrame([(float(i), "g") for i in range(200)] + [(odd, "g")], "v double, g string")
    small, large = (quantiles(df, "v", [0.25, 0.5], by=by, rows_per_task=n).first()["quantiles"] for n in (1000, 20))
    assert small == large


def test_rows_without_a_key_are_split_and_folded(spark):
    df = spark.createDataFrame([(1,), (2,), (None,), (None,), (5,)], "k int")
    train, test = train_test_split(df, "k", 0.4)
    assert train.count() + test.count() == 5
    assert add_folds(df, "k").where("fold IS NULL").count() == 0


def test_duplicates_without_a_key_keep_their_values(spark):
    df = spark.createDataFrame([("a", None, 5), ("b", None, 6), ("b", 1, 7)], "c string, k int, w int")
    assert sorted(tuple(r) for r in drop_duplicates(df, ["c"], "k").select("c", "w").collect()) == [("a", 5), ("b", 7)]


def test_repeated_predictions_do_not_multiply_rows(spark):
    sheet = spark.createDataFrame([(1, 0.0), (2, 0.0)], "id int, y double")
    scores = spark.createDataFrame([(1, 0.3), (1, 0.4)], "id int, prediction double")
    assert sorted(tuple(r) for r in attach_predictions(sheet, scores, "id", "y").collect()) == [(1, 0.4), (2, None)]
