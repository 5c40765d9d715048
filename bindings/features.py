from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from plumbline.functions.encode import map_values, replace_values
from plumbline.operators import features, split

from .registry import query, rounded

_ORDINAL = {"5-LOW": 0, "4-NOT SPECIFIED": 1, "3-MEDIUM": 2, "2-HIGH": 3, "1-URGENT": 4}


@query("replace_values", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN '0' WHEN 'O' THEN '1' ELSE o_orderstatus END AS o_orderstatus
FROM orders""")
def _(t):
    return replace_values(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", {"F": 0, "O": 1})


@query("map_values", """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS o_orderstatus FROM orders""")
def _(t):
    return map_values(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus", {"F": 1, "O": 0})


@query("ordinal_map", "SELECT o_orderkey, CASE o_orderpriority " + " ".join(
    f"WHEN '{k}' THEN {v}" for k, v in _ORDINAL.items()) + " END AS o_orderpriority FROM orders")
def _(t):
    return map_values(t.orders.select("o_orderkey", "o_orderpriority"), "o_orderpriority", _ORDINAL)


@query("feature_engineering", """
SELECT event_id, a AS "Age", a * va AS "Age_Vehicle_Age", a * pi AS "Age_Previously_Insured",
       va * vd AS "Vehicle_Age_Damage", pi * vd AS "Previously_Insured_Damage", a * a AS "Age_squared",
       va * va AS "Vehicle_Age_squared", round(value / (a + 1), 9) AS "Annual_Premium_per_Age"
FROM (SELECT event_id, value, CAST(user_id % 60 AS DOUBLE) AS a, CAST(event_id % 3 AS DOUBLE) AS va,
             CAST(event_id % 2 AS DOUBLE) AS pi, CAST(event_type = 'click' AS INTEGER)::DOUBLE AS vd FROM events)""")
def _(t):
    rows = t.events.select(
        "event_id",
        (F.col("user_id") % 60).cast("double").alias("Age"),
        (F.col("event_id") % 3).alias("Vehicle_Age"),
        (F.col("event_id") % 2).alias("Previously_Insured"),
        (F.col("event_type") == "click").cast("int").alias("Vehicle_Damage"),
        F.col("value").alias("Annual_Premium"),
    )
    made = features.insurance_features(rows)
    return rounded(made.drop("Vehicle_Age", "Previously_Insured", "Vehicle_Damage", "Annual_Premium"), 9)


@query("standardize", """
SELECT c_custkey, round((c_acctbal - m) / CASE WHEN s = 0 THEN 1 ELSE s END, 6) AS c_acctbal
FROM customer CROSS JOIN (SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS s FROM customer)""")
def _(t):
    return rounded(features.standardize(t.customer.select("c_custkey", "c_acctbal"), ["c_acctbal"]), 6)


@query("standardize_with_fitted", """
SELECT s_suppkey, round((s_acctbal - m) / s, 6) AS s_acctbal
FROM supplier CROSS JOIN (SELECT avg(c_acctbal) AS m, stddev_pop(c_acctbal) AS s FROM customer)""")
def _(t):
    """Fitted on customers, applied to suppliers."""
    scaler = features.fit_scaler(t.customer.select(F.col("c_acctbal").alias("s_acctbal")))
    return rounded(features.apply_scaler(t.supplier.select("s_suppkey", "s_acctbal"), scaler), 6)


@query("features_and_label", """
SELECT o_orderkey, CAST(o_custkey AS DOUBLE) AS f0, o_totalprice AS f1, CAST(o_orderstatus = 'F' AS INTEGER)::DOUBLE AS label
FROM orders""")
def _(t):
    rows = t.orders.withColumn("done", (F.col("o_orderstatus") == "F").cast("int"))
    made = features.features_and_label(rows, "done", ["o_custkey", "o_totalprice"], keep=["o_orderkey"])
    flat = vector_to_array("features")
    return made.select("o_orderkey", flat[0].alias("f0"), flat[1].alias("f1"), "label")


@query("train_test_split", """
SELECT o_orderkey, substr(md5(concat(CAST(o_orderkey AS VARCHAR), '-42')), 1, 8) < '33333333' AS is_test FROM orders""")
def _(t):
    return split.mark_split(t.orders.select("o_orderkey"), "o_orderkey", 0.2, 42)


@query("train_test_split_exact", """
SELECT o_orderkey FROM orders
ORDER BY substr(md5(concat(CAST(o_orderkey AS VARCHAR), '-42')), 1, 8),
         substr(md5(concat(CAST(o_orderkey AS VARCHAR), '-more-42')), 1, 4)
LIMIT (SELECT CAST(ceil(0.2 * count(*)) AS BIGINT) FROM orders)""")
def _(t):
    return split.train_test_split(t.orders.select("o_orderkey"), "o_orderkey", 0.2, 42, exact=True)[1]


@query("cv_folds", """
SELECT o_orderkey, CAST(d >= '33333333' AS INTEGER) + CAST(d >= '66666666' AS INTEGER)
     + CAST(d >= '99999999' AS INTEGER) + CAST(d >= 'cccccccc' AS INTEGER) AS fold
FROM (SELECT o_orderkey, substr(md5(concat(CAST(o_orderkey AS VARCHAR), '-fold-42')), 1, 8) AS d FROM orders)""")
def _(t):
    return split.add_folds(t.orders.select("o_orderkey"), "o_orderkey", 5, 42)


@query("stratified_fold_sizes", """
SELECT o_orderstatus, CAST(f AS INTEGER) AS fold, n // 5 + CAST(f < n % 5 AS BIGINT) AS n
FROM (SELECT o_orderstatus, count(*) AS n, unnest(range(5)) AS f FROM orders GROUP BY o_orderstatus)""")
def _(t):
    rows = split.add_stratified_folds(t.orders.select("o_orderkey", "o_orderstatus"), "o_orderkey", "o_orderstatus")
    return rows.groupBy("o_orderstatus", "fold").agg(F.count("*").alias("n"))
