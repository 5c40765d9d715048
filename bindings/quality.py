from plumbline.operators import quality

from .registry import HOLEY, HOLEY_COLUMNS, holey, query, rounded, union


@query("null_counts", union(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM {HOLEY}" for c in HOLEY_COLUMNS))
def _(t):
    return quality.null_counts(holey(t))


@query("missing_pct", union(
    f"SELECT '{c}' AS \"column\", round(100.0 * (count(*) - count({c})) / count(*), 4) AS missing_pct FROM {HOLEY}"
    for c in HOLEY_COLUMNS))
def _(t):
    return rounded(quality.missing_pct(holey(t)))


@query("midrange_impute", f"""
SELECT l_orderkey, l_quantity, round(coalesce(l_discount, m.d), 4) AS l_discount,
       round(coalesce(l_tax, m.x), 4) AS l_tax
FROM {HOLEY} h CROSS JOIN (SELECT (max(l_discount) + min(l_discount)) / 2 AS d,
                                  (max(l_tax) + min(l_tax)) / 2 AS x FROM {HOLEY}) m""")
def _(t):
    rows = holey(t).drop("l_returnflag")
    return rounded(quality.midrange_impute(rows, ["l_discount", "l_tax"]))


@query("drop_null_rows", f"""
SELECT * FROM {HOLEY} WHERE l_discount IS NOT NULL AND l_tax IS NOT NULL AND l_returnflag IS NOT NULL""")
def _(t):
    return quality.drop_null_rows(holey(t))


@query("drop_duplicates", f"SELECT DISTINCT l_discount, l_tax, l_returnflag FROM {HOLEY}")
def _(t):
    return quality.drop_duplicates(holey(t).select("l_discount", "l_tax", "l_returnflag"))


@query("drop_duplicates_by_key", """
SELECT event_id, user_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS rn FROM events) WHERE rn = 1""")
def _(t):
    rows = t.events.select("event_id", "user_id", "event_type", "value")
    return quality.drop_duplicates(rows, ["user_id", "event_type"], key="event_id")


@query("duplicate_marker", """
SELECT event_id, user_id, event_type,
       row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) > 1 AS is_duplicate FROM events""")
def _(t):
    return quality.mark_duplicates(t.events.select("event_id", "user_id", "event_type"), "event_id")


@query("duplicate_count", """
SELECT (SELECT count(*) FROM lineitem)
     - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS duplicates""")
def _(t):
    return quality.duplicate_count(t.lineitem.select("l_orderkey", "l_linenumber"))


_REPORT = ["l_orderkey", "l_discount", "l_returnflag"]


@query("quality_report", union(
    [f"SELECT '{c}' AS measure, count(*) - count({c}) AS value FROM {HOLEY}" for c in _REPORT]
    + [f"""SELECT '__duplicates__', (SELECT count(*) FROM lineitem)
           - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(_REPORT)} FROM {HOLEY}))"""]))
def _(t):
    return quality.quality_report(holey(t).select(*_REPORT))
