from pyspark.sql import functions as F

from plumbline.operators import chi2, metrics, position, select, split
from plumbline.plans.storage import fresh_path
from plumbline.sources.files import csv_roundtrip
from plumbline.sources.sales import sales_rows
from plumbline.sources.tables import replace_folder

from .registry import query, rounded, union


@query("select_columns", "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders")
def _(t):
    return select.select_columns(t.orders, ["o_orderkey", "o_totalprice", "o_orderstatus"])


@query("all_but_last", "SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer")
def _(t):
    return select.all_but_last(t.customer)


@query("drop_columns", "SELECT p_partkey, p_brand, p_size, p_retailprice FROM part")
def _(t):
    return select.drop_columns(t.part, ["p_name", "p_type"])


@query("select_numeric", "SELECT c_custkey, c_nationkey, c_acctbal FROM customer")
def _(t):
    return select.select_numeric(t.customer)


@query("range_filters", """
SELECT 'outside' AS part, l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity < 5 OR l_quantity > 45
UNION ALL
SELECT 'within', l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity >= 10 AND l_quantity <= 12""")
def _(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    part = lambda name, df: df.select(F.lit(name).alias("part"), "*")
    return part("outside", select.outside(rows, "l_quantity", 5, 45)).unionByName(
        part("within", select.within(rows, "l_quantity", 10, 12))
    )


@query("column_guard", union(
    [f"SELECT '{c}' AS \"column\", true AS present, count(DISTINCT {c}) > 1 AS usable FROM lineitem"
     for c in ("l_returnflag", "l_linestatus", "l_quantity")]
    + ["SELECT 'Response', false, false",
       "SELECT 'one_value', true, count(DISTINCT 1) > 1 FROM lineitem"]))
def _(t):
    return select.column_guard(
        t.lineitem.withColumn("one_value", F.lit(1)),
        ["l_returnflag", "l_linestatus", "l_quantity", "Response", "one_value"],
    )


@query("head_n", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 10")
def _(t):
    return select.head(t.orders, "o_orderkey", 10)


@query("tail_n", "SELECT * FROM orders ORDER BY o_orderkey DESC LIMIT 10")
def _(t):
    return select.tail(t.orders, "o_orderkey", 10)


@query("sort_offset", """
SELECT event_type, round(avg(value), 4) AS mean FROM events GROUP BY event_type
ORDER BY avg(value) DESC, event_type OFFSET 1""")
def _(t):
    means = t.events.groupBy("event_type").agg(F.avg("value").alias("mean"))
    return rounded(select.sort_desc(means, "mean", tie=["event_type"], skip=1))


def _auc_sql(score):
    return f"""(WITH g AS (SELECT {score} AS s, count(*) FILTER (WHERE l_returnflag = 'R') AS p,
      count(*) FILTER (WHERE l_returnflag <> 'R') AS n FROM lineitem GROUP BY 1),
 c AS (SELECT *, sum(n) OVER (ORDER BY s) - n AS below FROM g)
 SELECT CAST(sum(p * (below + n / 2.0)) AS DOUBLE) / (CAST(sum(p) AS DOUBLE) * CAST(sum(n) AS DOUBLE)) FROM c)"""


@query("best_candidate", f"""
SELECT idx, candidate, round(auc, 6) AS auc FROM (
 SELECT CAST(0 AS BIGINT) AS idx, 'l_quantity' AS candidate, {_auc_sql('l_quantity')} AS auc UNION ALL
 SELECT 1, 'l_discount', {_auc_sql('l_discount')} UNION ALL
 SELECT 2, 'l_tax', {_auc_sql('l_tax')})
ORDER BY auc DESC, idx LIMIT 1""")
def _(t):
    rows = t.lineitem.withColumn("label", (F.col("l_returnflag") == "R").cast("int"))
    table = metrics.candidate_auc(rows, "label", ["l_quantity", "l_discount", "l_tax"])
    return rounded(select.best_row(table, "auc", "idx"), 6)


@query("attach_predictions", """
SELECT o.o_orderkey, o.o_custkey, p.prediction AS "Response"
FROM orders o LEFT JOIN (SELECT o_orderkey, o_totalprice / 2 AS prediction FROM orders
                         WHERE o_orderstatus <> 'F') p ON o.o_orderkey = p.o_orderkey""")
def _(t):
    sheet = t.orders.select("o_orderkey", "o_custkey", F.lit(0.0).alias("Response"))
    scores = t.orders.where("o_orderstatus <> 'F'").select("o_orderkey", (F.col("o_totalprice") / 2).alias("prediction"))
    return select.attach_predictions(sheet, scores, "o_orderkey", "Response")


@query("csv_roundtrip", "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def _(t):
    sheet = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    return csv_roundtrip(sheet, fresh_path(t.spark, "csv"))


@query("table_roundtrip", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def _(t):
    sheet = t.customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    return t.spark.read.parquet(replace_folder(sheet, fresh_path(t.spark, "table")))


def _pick(field, size):
    return f"(CAST('0x' || substr(md5(concat(CAST(o_orderkey AS VARCHAR), '-{field}-0')), 1, 8) AS BIGINT) % {size})"


@query("synthetic_sales", f"""
SELECT o_orderkey,
       'SHOP_' || lpad(CAST({_pick('shop_code', 999)} + 1 AS VARCHAR), 5, '0') AS shop_code,
       CAST({_pick('year_no', 5)} + 2020 AS INTEGER) AS year_no,
       CAST({_pick('week_no', 52)} + 1 AS INTEGER) AS week_no,
       'PROD_' || lpad(CAST({_pick('product_no', 9999)} + 1 AS VARCHAR), 6, '0') AS product_no,
       'Product_' || CAST({_pick('product_name', 9999)} + 1 AS VARCHAR) AS product_name,
       'CLR_' || lpad(CAST({_pick('color_no', 99)} + 1 AS VARCHAR), 3, '0') AS color_no,
       'Color_' || CAST({_pick('color_name', 99)} + 1 AS VARCHAR) AS color_name,
       {_pick('is_top', 2)} = 1 AS is_top
FROM orders""")
def _(t):
    return sales_rows(t.orders, "o_orderkey", how="md5", keep_key=True)


@query("head_file_order", """
SELECT event_id, event_type, position FROM (
  SELECT event_id, event_type, row_number() OVER () - 1 AS position, count(*) OVER () AS n FROM events)
WHERE position < 7 OR position >= n - 4""")
def _(t):
    rows = t.events.select("event_id", "event_type")
    return position.head_in_file(rows, 7).unionByName(position.tail_in_file(rows, 4))


@query("keep_first_file_order", """
SELECT l_partkey, l_returnflag, l_orderkey FROM (
  SELECT *, row_number() OVER (PARTITION BY l_partkey, l_returnflag ORDER BY place) AS n
  FROM (SELECT *, row_number() OVER () AS place FROM lineitem)) WHERE n = 1""")
def _(t):
    rows = t.lineitem.select("l_partkey", "l_returnflag", "l_orderkey")
    return position.keep_first_in_file(rows, ["l_partkey", "l_returnflag"])


@query("attach_by_position", """
SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS predicted FROM lineitem""")
def _(t):
    made = t.lineitem.select(F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4).alias("net"))
    return position.attach_by_position(t.lineitem.select("l_orderkey", "l_linenumber"), made, "net", "predicted")


@query("split_with_null_keys", """
WITH r AS (SELECT CASE WHEN l_orderkey % 3 <> 0 THEN l_orderkey END AS k, l_partkey, l_suppkey, l_linenumber FROM lineitem),
 d AS (SELECT k, substr(md5(concat(coalesce(CAST(k AS VARCHAR), concat('NULL|', l_partkey, '|', l_suppkey, '|', l_linenumber)), '-42')), 1, 8) AS d FROM r)
SELECT k IS NULL AS keyless, count(*) AS n, count(*) FILTER (d < '33333333') AS n_test FROM d GROUP BY 1""")
def _(t):
    rows = t.lineitem.select(F.when(F.col("l_orderkey") % 3 != 0, F.col("l_orderkey")).alias("k"), "l_partkey", "l_suppkey", "l_linenumber")
    marked = split.mark_split(rows, "k", 0.2, 42)
    return marked.groupBy(F.col("k").isNull().alias("keyless")).agg(F.count("*").alias("n"), F.count_if("is_test").alias("n_test"))


_CHI2 = ["l_quantity", "l_discount", "l_tax", "l_linenumber"]


@query("chi2_scores", f"""
WITH o AS ({union(f"SELECT '{c}' AS feature, l_returnflag, sum({c})::DOUBLE AS mass, count(*) AS n FROM lineitem GROUP BY l_returnflag" for c in _CHI2)}),
 e AS (SELECT feature, mass, sum(mass) OVER f * n / sum(n) OVER f AS expected FROM o WINDOW f AS (PARTITION BY feature)),
 s AS (SELECT feature, sum((mass - expected) ^ 2 / expected) AS chi2 FROM e GROUP BY feature)
SELECT feature, round(chi2, 4) AS chi2, row_number() OVER (ORDER BY chi2 DESC, feature) AS rank FROM s""")
def _(t):
    return rounded(chi2.chi2_scores(t.lineitem, "l_returnflag", _CHI2))
