from pyspark.sql import functions as F

from plumbline.ml import clusters
from plumbline.operators import metrics

from .registry import query, rounded


def _scored(t):
    return t.lineitem.select(
        (F.col("l_returnflag") == "R").cast("int").alias("label"), F.col("l_extendedprice").alias("score")
    )


_G = """WITH g AS (SELECT l_extendedprice AS s, count(*) FILTER (WHERE l_returnflag = 'R') AS p,
      count(*) FILTER (WHERE l_returnflag <> 'R') AS n FROM lineitem GROUP BY 1),
 t AS (SELECT CAST(sum(p) AS DOUBLE) AS tp, CAST(sum(n) AS DOUBLE) AS tn FROM g)"""


@query("regression_metrics", """
SELECT round(avg(abs(y - p)), 4) AS mae, round(avg((y - p) ^ 2), 4) AS mse,
       round(1 - avg((y - p) ^ 2) / var_pop(y), 6) AS r2
FROM (SELECT l_extendedprice AS y, l_quantity * 3000.0 AS p FROM lineitem)""")
def _(t):
    rows = t.lineitem.select(
        F.col("l_extendedprice").alias("label"), (F.col("l_quantity") * 3000.0).alias("prediction")
    )
    found = metrics.regression_metrics(rows)
    return found.select(F.round("mae", 4).alias("mae"), F.round("mse", 4).alias("mse"), F.round("r2", 6).alias("r2"))


@query("classification_metrics", """
SELECT round(avg(CAST(y = p AS INTEGER)), 6) AS accuracy,
       round(count(*) FILTER (WHERE y = 1 AND p = 1) / count(*) FILTER (WHERE y = 1)::DOUBLE, 6) AS recall
FROM (SELECT CAST(l_returnflag = 'R' AS INTEGER) AS y, CAST(l_quantity > 30 AS INTEGER) AS p FROM lineitem)""")
def _(t):
    rows = t.lineitem.select(
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        (F.col("l_quantity") > 30).cast("int").alias("prediction"),
    )
    return rounded(metrics.classification_metrics(rows), 6)


_CURVE = _G + """, c AS (SELECT s, p, n, sum(p) OVER w AS cp, sum(n) OVER w AS cn,
     lead(p) OVER (ORDER BY s DESC) AS next_p, lead(n) OVER (ORDER BY s DESC) AS next_n,
     row_number() OVER (ORDER BY s DESC) AS rn FROM g WINDOW w AS (ORDER BY s DESC))
SELECT CAST(NULL AS DOUBLE) AS threshold, CAST(0 AS DOUBLE) AS fpr, CAST(0 AS DOUBLE) AS tpr
UNION ALL SELECT s, round(cn / tn, 6), round(cp / tp, 6) FROM c, t"""


@query("roc_curve", _CURVE)
def _(t):
    return rounded(metrics.roc_curve(_scored(t)).select("threshold", "fpr", "tpr"), 6)


@query("roc_curve_in_ranges", _CURVE)
def _(t):
    """The way taken by more scores than one task can sort."""
    return rounded(metrics.roc_curve(_scored(t), rows_per_task=5_000).select("threshold", "fpr", "tpr"), 6)


@query("roc_curve_turns", _CURVE + " WHERE rn = 1 OR next_p IS NULL OR next_p <> p OR next_n <> n")
def _(t):
    return rounded(metrics.roc_curve(_scored(t), drop_intermediate=True), 6)


_AUC = _G + """, c AS (SELECT *, sum(n) OVER (ORDER BY s) - n AS below FROM g)
SELECT round(CAST(sum(p * (below + n / 2.0)) AS DOUBLE) / (SELECT tp * tn FROM t), 8) AS auc FROM c"""


@query("auc_trapezoid", _AUC)
def _(t):
    return rounded(metrics.auc_trapezoid(metrics.roc_curve(_scored(t))), 8)


@query("roc_auc", _AUC)
def _(t):
    return rounded(metrics.roc_auc(_scored(t)), 8)


@query("cluster_centers", """
SELECT cluster, dim, round(avg(v), 6) AS value FROM (
  SELECT label AS cluster, CAST(unnest(range(len(embedding))) AS INTEGER) AS dim, CAST(unnest(embedding) AS DOUBLE) AS v
  FROM embeddings) GROUP BY cluster, dim""")
def _(t):
    return rounded(clusters.assigned_centers(t.embeddings, "label", "embedding"), 6)


@query("cluster_inertia", """
WITH p AS (SELECT vec_id, CAST(unnest(range(len(embedding))) AS INTEGER) AS dim, CAST(unnest(embedding) AS DOUBLE) AS v, label
           FROM embeddings),
 c AS (SELECT label AS cluster, dim, avg(v) AS v FROM p GROUP BY label, dim),
 d AS (SELECT vec_id, cluster, sum((p.v - c.v) ^ 2) AS d FROM p JOIN c ON p.dim = c.dim GROUP BY vec_id, cluster)
SELECT round(sum(m), 4) AS inertia FROM (SELECT min(d) AS m FROM d GROUP BY vec_id)""")
def _(t):
    centers = clusters.assigned_centers(t.embeddings, "label", "embedding")
    return rounded(clusters.inertia(t.embeddings, "embedding", centers))
