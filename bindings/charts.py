from pyspark.sql import functions as F

from plumbline.operators import charts, outliers

from .registry import NUMBERS, query, rounded, union

_WIDE = ["l_quantity", "l_extendedprice", "l_discount"]


def _fences(table, columns, group=""):
    key, by = (f"{group}, ", f" GROUP BY {group}") if group else ("", "")
    return union(
        f"""SELECT {key}'{c}' AS col, q1, median, q3, q1 - 1.5 * (q3 - q1) AS low, q3 + 1.5 * (q3 - q1) AS high FROM (
            SELECT {key}quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median,
                   quantile_cont({c}, 0.75) AS q3 FROM {table}{by})""" for c in columns)


@query("iqr_fences", f"""
SELECT col AS "column", round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
       round(low, 6) AS low, round(high, 6) AS high FROM ({_fences('lineitem', NUMBERS)})""")
def _(t):
    found = outliers.iqr_fences(t.lineitem, NUMBERS)
    return found.select("column", *[F.round(c, 4).alias(c) for c in ("q1", "median", "q3")],
                        *[F.round(c, 6).alias(c) for c in ("low", "high")])


@query("iqr_clean", f"""
WITH f AS ({_fences('events', ['value', 'user_id'])})
SELECT e.event_id, e.user_id, e.value FROM events e
WHERE e.value BETWEEN (SELECT low FROM f WHERE col = 'value') AND (SELECT high FROM f WHERE col = 'value')
  AND e.user_id BETWEEN (SELECT low FROM f WHERE col = 'user_id') AND (SELECT high FROM f WHERE col = 'user_id')""")
def _(t):
    return outliers.iqr_clean(t.events.select("event_id", "user_id", "value"), exclude=["event_id"])


@query("iqr_outliers", f"WITH f AS ({_fences('events', ['value'])} UNION ALL {_fences('(SELECT sqrt(value) AS root FROM events)', ['root'])})" + """
SELECT 'value' AS outlier_column, value AS outlier_value, event_id FROM events
WHERE value < (SELECT low FROM f WHERE col = 'value') OR value > (SELECT high FROM f WHERE col = 'value')
UNION ALL
SELECT 'root', round(sqrt(value), 6), event_id FROM events
WHERE sqrt(value) < (SELECT low FROM f WHERE col = 'root') OR sqrt(value) > (SELECT high FROM f WHERE col = 'root')""")
def _(t):
    rows = t.events.select("event_id", "value", F.sqrt("value").alias("root"))
    found = outliers.iqr_outliers(rows, ["value", "root"]).select("outlier_column", "outlier_value", "event_id")
    return rounded(found, 6)


@query("box_stats", f"WITH f AS ({_fences('lineitem', _WIDE)})\n" + union(
    f"""SELECT '{c}' AS "column", round(any_value(q1), 4) AS q1, round(any_value(median), 4) AS median,
        round(any_value(q3), 4) AS q3, min({c}) FILTER (WHERE {c} BETWEEN low AND high) AS whisker_low,
        max({c}) FILTER (WHERE {c} BETWEEN low AND high) AS whisker_high,
        count(*) FILTER (WHERE {c} < low OR {c} > high) AS n_outliers
        FROM lineitem, f WHERE col = '{c}'""" for c in _WIDE))
def _(t):
    return rounded(charts.box_stats(t.lineitem, _WIDE))


@query("box_stats_by", f"""
WITH f AS ({_fences('events', ['value'], 'event_type')})
SELECT e.event_type, round(any_value(q1), 4) AS q1, round(any_value(median), 4) AS median, round(any_value(q3), 4) AS q3,
       min(value) FILTER (WHERE value BETWEEN low AND high) AS whisker_low,
       max(value) FILTER (WHERE value BETWEEN low AND high) AS whisker_high,
       count(*) FILTER (WHERE value < low OR value > high) AS n_outliers
FROM events e JOIN f ON e.event_type = f.event_type GROUP BY e.event_type""")
def _(t):
    return rounded(charts.box_stats_by(t.events, "event_type", "value"))


def _histogram(table, column, bins):
    return f"""
WITH e AS (SELECT lo, hi, b, (hi - lo) / b AS w FROM (
             SELECT min({column})::DOUBLE AS lo, max({column})::DOUBLE AS hi, {bins} AS b FROM {table})),
 c AS (SELECT least(CAST(floor(({column} - lo) / w) AS BIGINT), b - 1) AS bin, count(*) AS n
       FROM {table}, e WHERE {column} IS NOT NULL GROUP BY 1)
SELECT g.bin, round(lo + g.bin * w, 8) AS "left", round(lo + (g.bin + 1) * w, 8) AS "right", coalesce(n, 0) AS n
FROM (SELECT CAST(unnest(range(0, b)) AS BIGINT) AS bin, lo, w FROM e) g LEFT JOIN c ON g.bin = c.bin"""


@query("histogram", _histogram("events", "value", "35"))
def _(t):
    return rounded(charts.histogram(t.events, "value", bins=35), 8)


@query("histogram_auto", _histogram("events", "value", f"greatest(1, CAST(floor((max(value) - min(value)) / 30) AS BIGINT))"))
def _(t):
    return rounded(charts.histogram(t.events, "value"), 8)


def _density(table, column, points, cut, group=""):
    """Density by (group, point); the cross join with the grid is the definition."""
    key, by = (f"{group}, ", f"GROUP BY {group}") if group else ("", "")
    same = f"AND s.{group} = v.{group}" if group else ""
    return f"""
SELECT {f's.{group}, ' if group else ''}CAST(p.i AS INTEGER) AS point, lo + p.i * ((hi - lo) / {points - 1}) AS x,
       sum(v.w * exp(-0.5 * ((lo + p.i * ((hi - lo) / {points - 1}) - v.x) / h) ^ 2)) / (any_value(n) * any_value(h) * sqrt(2 * pi())) AS density
FROM (SELECT {key}n, h, mn - {cut} * h AS lo, mx + {cut} * h AS hi FROM (
        SELECT {key}count({column}) AS n, stddev_samp({column}) * pow(count({column}), -0.2) AS h,
               min({column}) AS mn, max({column}) AS mx FROM {table} {by})) s
CROSS JOIN (SELECT unnest(range({points})) AS i) p
JOIN (SELECT {key}{column} AS x, count(*) AS w FROM {table} WHERE {column} IS NOT NULL GROUP BY ALL) v ON true {same}
GROUP BY {f's.{group}, ' if group else ''}p.i, lo, hi, h"""


@query("kde_curve", f"SELECT point, round(x, 4) AS x, round(density, 8) AS density FROM ({_density('events', 'value', 200, 0)})")
def _(t):
    curve = charts.kde_curve(t.events, "value")
    return curve.select("point", F.round("x", 4).alias("x"), F.round("density", 8).alias("density"))


_LINE_NUMBERS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_VIOLIN = "(" + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {c}::DOUBLE AS value FROM lineitem" for c in _LINE_NUMBERS) + ")"


@query("violin_stats", f"""
SELECT d."column", point, round(x, 4) AS x, round(density, 6) AS density, round(q1, 4) AS q1,
       round(median, 4) AS median, round(q3, 4) AS q3
FROM ({_density(_VIOLIN, 'value', 100, 0, '"column"')}) d
JOIN (SELECT "column", quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
             quantile_cont(value, 0.75) AS q3 FROM {_VIOLIN} GROUP BY "column") q ON d."column" = q."column" """)
def _(t):
    found = charts.violin_stats(t.lineitem)
    return found.select("column", "point", *[F.round(c, 4).alias(c) for c in ("x", "q1", "median", "q3")],
                        F.round("density", 6).alias("density"))


_HUED = "(SELECT concat(l_returnflag, '/', l_linestatus) AS g, l_quantity FROM lineitem)"


@query("violin_by_hue", f"""
SELECT split_part(d.g, '/', 1) AS l_returnflag, split_part(d.g, '/', 2) AS l_linestatus, point, round(x, 4) AS y,
       round(density, 6) AS density, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3
FROM ({_density(_HUED, 'l_quantity', 100, 2, 'g')}) d
JOIN (SELECT g, quantile_cont(l_quantity, 0.25) AS q1, quantile_cont(l_quantity, 0.5) AS median,
             quantile_cont(l_quantity, 0.75) AS q3 FROM {_HUED} GROUP BY g) q ON d.g = q.g""")
def _(t):
    found = charts.violin_by_hue(t.lineitem, "l_returnflag", "l_quantity", "l_linestatus")
    return found.select("l_returnflag", "l_linestatus", "point",
                        *[F.round(c, 4).alias(c) for c in ("y", "q1", "median", "q3")],
                        F.round("density", 6).alias("density"))
