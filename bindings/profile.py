from pyspark.sql import functions as F

from plumbline.operators import correlation, profile

from .registry import HOLEY, HOLEY_COLUMNS, NUMBERS, holey, query, rounded, union


@query("shape", "SELECT count(*) AS n_rows, CAST(11 AS BIGINT) AS n_columns FROM lineitem")
def _(t):
    return profile.shape(t.lineitem)


_TYPES = ["bigint", "double", "double", "double", "string"]


@query("info", union(
    f"SELECT CAST({i} AS BIGINT) AS position, '{c}' AS \"column\", count({c}) AS non_null, '{k}' AS dtype FROM {HOLEY}"
    for i, (c, k) in enumerate(zip(HOLEY_COLUMNS, _TYPES))))
def _(t):
    return profile.info(holey(t))


@query("describe_numeric", union(
    f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
       round(min({c}), 4) AS min, round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50,
       round(quantile_cont({c}, 0.75), 4) AS q75, round(max({c}), 4) AS max FROM lineitem""" for c in NUMBERS))
def _(t):
    return rounded(profile.describe_numeric(t.lineitem, NUMBERS))


_TEXTS = ["o_orderstatus", "o_orderpriority"]


@query("describe_categorical", union(
    f"""SELECT '{c}' AS "column", count({c}) AS count, count(DISTINCT {c}) AS "unique",
       (SELECT {c} FROM orders GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS top,
       (SELECT count(*) FROM orders GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS freq FROM orders""" for c in _TEXTS))
def _(t):
    return profile.describe_text(t.orders)


@query("column_means", union(
    f"SELECT '{c}' AS \"column\", round(avg({c}), 4) AS mean FROM lineitem" for c in NUMBERS))
def _(t):
    return rounded(profile.column_means(t.lineitem, NUMBERS))


@query("column_medians", union(
    f"SELECT '{c}' AS \"column\", round(median({c}), 4) AS median FROM lineitem" for c in NUMBERS))
def _(t):
    return rounded(profile.column_medians(t.lineitem, NUMBERS))


@query("column_stds", union(
    f"SELECT '{c}' AS \"column\", round(stddev_samp({c}), 4) AS std FROM lineitem" for c in NUMBERS))
def _(t):
    return rounded(profile.column_stds(t.lineitem, NUMBERS))


@query("std_of_stds", "SELECT round(stddev_pop(s), 4) AS std_of_stds FROM (" + union(
    f"SELECT stddev_samp({c}) AS s FROM lineitem" for c in NUMBERS) + ")")
def _(t):
    return rounded(profile.std_of_stds(t.lineitem, NUMBERS))


@query("column_extremes", union(
    f"SELECT '{c}' AS \"column\", min({c}) AS min, max({c}) AS max FROM lineitem" for c in NUMBERS))
def _(t):
    return profile.column_extremes(t.lineitem, NUMBERS)


_PROBS = [0.01, 0.25, 0.5, 0.75, 0.99]


@query("quantiles", union(
    f"SELECT '{c}' AS \"column\", CAST({q} AS DOUBLE) AS q, round(quantile_cont({c}, {q}), 4) AS value FROM lineitem"
    for c in NUMBERS for q in _PROBS))
def _(t):
    return rounded(profile.quantile_table(t.lineitem, NUMBERS, _PROBS))


@query("quantiles_narrowed", union(
    f"SELECT '{c}' AS \"column\", CAST({q} AS DOUBLE) AS q, round(quantile_cont({c}, {q}), 4) AS value FROM lineitem"
    for c in NUMBERS for q in _PROBS))
def _(t):
    """The way taken by tables too large for one task, on a table that is not."""
    return rounded(profile.quantile_table(t.lineitem, NUMBERS, _PROBS, rows_per_task=1_000))


@query("distinct_counts", union(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS n_distinct FROM {HOLEY}" for c in HOLEY_COLUMNS))
def _(t):
    return profile.distinct_counts(holey(t))


_UNIQUE = ["o_custkey", "o_orderstatus", "o_orderpriority"]


@query("unique_values", union(
    f"SELECT DISTINCT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value FROM orders" for c in _UNIQUE))
def _(t):
    return profile.unique_values(t.orders, ["o_orderkey", *_UNIQUE], exclude=["o_orderkey"])


def _corr(a, b):
    return f"SELECT '{a}' AS col_x, '{b}' AS col_y, round(corr({a}, {b}), 4) + 0.0 AS corr FROM {HOLEY}"


_PAIRED = ["l_quantity", "l_discount", "l_tax"]


@query("correlation_matrix", union(_corr(a, b) for a in _PAIRED for b in _PAIRED))
def _(t):
    found = rounded(correlation.correlation_matrix(holey(t), _PAIRED))
    return found.withColumn("corr", F.col("corr") + F.lit(0.0))


@query("heatmap_cells", union(
    f"SELECT '{a}' AS col_x, '{b}' AS col_y, round(corr({a}, {b}), 2) + 0.0 AS label FROM lineitem"
    for a in NUMBERS for b in NUMBERS))
def _(t):
    cells = correlation.heatmap_cells(t.lineitem, NUMBERS)
    return cells.select("col_x", "col_y", (F.col("label") + F.lit(0.0)).alias("label"))


@query("target_correlation", "SELECT * FROM (" + union(
    f"SELECT '{c}' AS \"column\", round(corr({c}, l_extendedprice), 4) + 0.0 AS corr FROM lineitem"
    for c in NUMBERS if c != "l_extendedprice") + ") ORDER BY corr DESC, \"column\"")
def _(t):
    found = rounded(correlation.target_correlation(t.lineitem, "l_extendedprice", NUMBERS))
    return found.withColumn("corr", F.col("corr") + F.lit(0.0))
