from pyspark.sql import functions as F

from plumbline.functions.hashing import cut
from plumbline.operators import tabulate

from .registry import query, rounded, union

_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
_FLAGS = ["A", "N", "R"]


@query("value_counts", """
SELECT event_type AS value, count(*) AS n FROM events WHERE event_type IS NOT NULL GROUP BY event_type""")
def _(t):
    return tabulate.value_counts(t.events, "event_type")


@query("value_shares", """
SELECT event_type AS value, count(*) AS n, round(count(*) / (SELECT count(event_type) FROM events)::DOUBLE, 6) AS share
FROM events GROUP BY event_type""")
def _(t):
    return rounded(tabulate.value_shares(t.events, "event_type"), 6)


@query("pie_shares", """
SELECT l_returnflag AS value, count(*) AS n, round(count(*) / (SELECT count(*) FROM lineitem)::DOUBLE, 6) AS share,
       round(100.0 * count(*) / (SELECT count(*) FROM lineitem), 1) AS percent
FROM lineitem GROUP BY l_returnflag""")
def _(t):
    return rounded(tabulate.pie_shares(t.lineitem, "l_returnflag"), 6)


@query("nested_shares", union(
    f"""SELECT '{ring}' AS ring, '{c}' AS "column", {c} AS value, count(*) AS n,
        round(count(*) / (SELECT count(*) FROM lineitem)::DOUBLE, 6) AS share,
        round(100.0 * count(*) / (SELECT count(*) FROM lineitem), 1) AS percent FROM lineitem GROUP BY {c}"""
    for ring, c in (("outer", "l_returnflag"), ("inner", "l_linestatus"))))
def _(t):
    return rounded(tabulate.nested_shares(t.lineitem, "l_returnflag", "l_linestatus"), 6)


@query("count_by_hue", """
SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderpriority, o_orderstatus""")
def _(t):
    return tabulate.count_by(t.orders, ["o_orderpriority", "o_orderstatus"])


@query("crosstab_row_share", "SELECT l_suppkey, " + ", ".join(
    f"round(count(*) FILTER (WHERE l_returnflag = '{v}') / count(*)::DOUBLE, 6) AS \"{v}\"" for v in _FLAGS)
    + " FROM lineitem GROUP BY l_suppkey")
def _(t):
    return rounded(tabulate.crosstab(t.lineitem, "l_suppkey", "l_returnflag", _FLAGS, normalize="index"), 6)


@query("crosstab_col_share", "SELECT o_orderstatus, " + ", ".join(
    f"""round(count(*) FILTER (WHERE o_orderpriority = '{v}')
        / (SELECT count(*) FROM orders WHERE o_orderpriority = '{v}')::DOUBLE, 6) AS "{v}" """ for v in _PRIORITIES)
    + " FROM orders WHERE o_orderpriority IN (" + ", ".join(f"'{v}'" for v in _PRIORITIES)
    + ") GROUP BY o_orderstatus ORDER BY \"1-URGENT\" DESC")
def _(t):
    table = tabulate.crosstab(t.orders, "o_orderstatus", "o_orderpriority", _PRIORITIES, normalize="columns")
    return rounded(table, 6).orderBy(F.desc("`1-URGENT`"), "o_orderstatus")


@query("crosstab_median", """
SELECT event_type, round(median(value), 4) AS "Test" FROM events GROUP BY event_type""")
def _(t):
    return rounded(tabulate.crosstab_median(t.events, "event_type", "value"))


@query("crosstab_median_wide", "SELECT o_orderpriority, " + ", ".join(
    f"round(median(o_totalprice) FILTER (WHERE o_orderstatus = '{v}'), 4) AS \"{v}\"" for v in ("F", "O", "P"))
    + " FROM orders GROUP BY o_orderpriority")
def _(t):
    return rounded(tabulate.crosstab_median(
        t.orders, "o_orderpriority", "o_totalprice", column="o_orderstatus", values=["F", "O", "P"]))


@query("group_mean", """
SELECT l_suppkey, round(avg(l_extendedprice), 4) AS mean, round(avg(l_extendedprice), 2) AS label FROM lineitem GROUP BY l_suppkey""")
def _(t):
    return rounded(tabulate.group_mean(t.lineitem, "l_suppkey", "l_extendedprice"))


@query("group_mean_by_hue", """
SELECT o_orderpriority, o_orderstatus, round(avg(o_totalprice), 4) AS mean
FROM orders GROUP BY o_orderpriority, o_orderstatus""")
def _(t):
    return rounded(tabulate.group_mean(t.orders, ["o_orderpriority", "o_orderstatus"], "o_totalprice").drop("label"))


@query("group_mean_ci", """
SELECT event_type, count(value) AS n, round(avg(value), 4) AS mean,
       round(avg(value) - 1.96 * stddev_samp(value) / sqrt(count(value)), 4) AS low,
       round(avg(value) + 1.96 * stddev_samp(value) / sqrt(count(value)), 4) AS high
FROM events GROUP BY event_type""")
def _(t):
    return rounded(tabulate.group_mean_ci(t.events, "event_type", "value"))


@query("group_mean_bootstrap", """
WITH b AS (SELECT o_orderpriority, CAST('0x' || substr(md5(concat(CAST(o_orderkey AS VARCHAR), '-block-0')), 1, 8) AS BIGINT) % 4096 AS block,
                  sum(o_totalprice) AS s, count(*) AS n FROM orders GROUP BY ALL),
 d AS (SELECT o_orderpriority, s, n, i, md5(concat(o_orderpriority, '|', block, '|', i, '-0')) AS d
       FROM (SELECT *, unnest(range(250)) AS i FROM b)),
 r AS (SELECT o_orderpriority, s, n, 4 * i + p AS rep, CAST('0x' || substr(d, 8 * p + 1, 8) AS BIGINT) AS draw
       FROM (SELECT *, unnest([0, 1, 2, 3]) AS p FROM d)),
 c AS (SELECT list(CAST(floor(share * 4294967296) AS BIGINT)) AS cuts
       FROM (SELECT sum(exp(-1) / factorial(k::INTEGER)) OVER (ORDER BY k) AS share FROM range(0, 12) t(k))),
 w AS (SELECT o_orderpriority, rep, s, n, len(list_filter(cuts, lambda x: x <= draw)) AS w FROM r, c),
 m AS (SELECT o_orderpriority, rep, sum(w * s) / sum(w * n) AS m FROM w GROUP BY o_orderpriority, rep)
SELECT a.o_orderpriority, round(a.mean, 4) AS mean, round(q.low, 4) AS low, round(q.high, 4) AS high
FROM (SELECT o_orderpriority, avg(o_totalprice) AS mean FROM orders GROUP BY o_orderpriority) a
JOIN (SELECT o_orderpriority, quantile_cont(m, 0.025) AS low, quantile_cont(m, 0.975) AS high FROM m GROUP BY o_orderpriority) q
  ON a.o_orderpriority = q.o_orderpriority""")
def _(t):
    return rounded(tabulate.group_mean_bootstrap(
        t.orders, "o_orderpriority", "o_totalprice", "o_orderkey", replicates=1_000))
