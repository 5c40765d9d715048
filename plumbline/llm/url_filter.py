"""URL filter: host and path rules, and a ratio of character language models.

Rules judge what they fit. Their verdicts are also the training data: one
variable-order Markov model is counted from accepted URLs and one from rejected
ones. A symbol is predicted from up to ``order`` symbols before it, and each
order is smoothed by the next shorter one (Witten-Bell). The mean of the log
ratio over a URL's symbols is compared with a threshold, calibrated on rule-judged
URLs that the counts leave out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import col
from ..plans.stats import one_row
from .common import hex_number, saved, small

#: Fixed values of the contract: verdict and rule, as host and path.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEPT = r"a-z0/.\-_?=&%#:~+"  # every digit counts as 0, any other symbol as *
SYMBOLS = 40
ORDER = 3
HELD_OUT = 5  # one of so many rule-judged URLs calibrates
MODEL_ROWS = 300_000  # a larger model is joined by a shuffle


def host_and_path(url: str) -> tuple[Column, Column]:
    """Both empty for a missing URL or one without ``://``."""
    text = F.coalesce(col(url), F.lit(""))
    rest = F.regexp_extract(text, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _fits(host: Column, path: Column, rule: str) -> Column:
    name, slash, start = rule.partition("/")
    return ((host == name) | host.endswith("." + name)) & path.startswith(slash + start)


def judged(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, key: str = "page_id", url: str = "url") -> DataFrame:
    """Adds ``__host, __path, __rule, __said``; the longest fitting rule counts."""
    host, path = host_and_path(url)
    rule = said = F.lit(None).cast("string")
    for verdict, text in sorted(rules, key=lambda r: len(r[1])):
        fits = _fits(F.col("__host"), F.col("__path"), text)
        rule, said = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(verdict)).otherwise(said)
    return pages.withColumns({"__host": host, "__path": path}).withColumns({"__rule": rule, "__said": said})


def folded(url: str) -> Column:
    lower = F.translate(F.coalesce(col(url), F.lit("")), UPPER + "123456789", LOWER + "0" * 9)
    return F.regexp_replace(lower, f"[^{KEPT}]", "*")


def _grams(rows: DataFrame, order: int) -> DataFrame:
    """One row per symbol, with the symbols before it; a URL starts with ``^``."""
    padded = F.concat(F.lit("^" * order), F.col("__text"))
    places = F.sequence(F.lit(1), F.char_length("__text"))
    grams = F.transform(places, lambda i: F.substring(padded, i, F.lit(order + 1)))
    return rows.where("__text <> ''").withColumn("__gram", F.explode(grams)).drop("__text")


def log_ratios(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """``__gram, __ratio`` from ``__gram, a, r``: counts of accepted and rejected URLs."""
    shorter = None
    for k in range(order + 1):
        level = counts.groupBy(F.right("__gram", F.lit(k + 1)).alias("g")).agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
        context = Window.partitionBy(F.left("g", F.lit(k)))  # at most SYMBOLS + 1 rows
        if shorter is None:
            level = level.withColumns({"pa": F.lit(1 / SYMBOLS), "pr": F.lit(1 / SYMBOLS)})
        else:
            level = level.join(shorter, F.right("g", F.lit(k)) == F.col("h"))
        for n, p in (("a", "pa"), ("r", "pr")):
            total, kinds = F.sum(n).over(context), F.sum((F.col(n) > 0).cast("long")).over(context)
            better = (F.col(n) + kinds * F.col(p)) / (total + kinds)
            level = level.withColumn(p, F.when(total > 0, better).otherwise(F.col(p)))
        level = level.select("g", "a", "r", "pa", "pr")
        shorter = level.select(F.col("g").alias("h"), "pa", "pr")
    return level.select(F.col("g").alias("__gram"), (F.ln("pa") - F.ln("pr")).alias("__ratio"))


def _threshold(scored: DataFrame) -> DataFrame:
    """The point between the held-out classes that lies equally many deviations from both means."""
    of = lambda f, said: F.coalesce(f(F.when((F.col("__said") == said) & (F.col("__fold") == 0), F.col("score"))), F.lit(0.0))
    row = scored.agg(
        of(F.avg, "allow").alias("ma"), of(F.avg, "block").alias("mb"), of(F.stddev_pop, "allow").alias("sa"), of(F.stddev_pop, "block").alias("sb")
    )
    between = F.try_divide(F.col("ma") * F.col("sb") + F.col("mb") * F.col("sa"), F.col("sa") + F.col("sb"))
    return row.select(F.coalesce(between, (F.col("ma") + F.col("mb")) / 2).alias("threshold"))


def filter_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    order: int = ORDER,
    key: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """One row per page: ``key, host, path, rule, verdict, score, threshold``.

    An empty or missing URL has score 0. Without judged URLs all scores and the
    threshold are 0, and what no rule fits is allowed.
    """
    fold = hex_number(F.substring(F.md5(F.coalesce(col(key).cast("string"), F.lit(""))), 1, 8)) % HELD_OUT
    rows = judged(pages, rules, key, url).select(
        F.monotonically_increasing_id().alias("__row"),
        col(key).alias("__key"),
        "__host",
        "__path",
        "__rule",
        "__said",
        fold.alias("__fold"),
        folded(url).alias("__text"),
    )
    rows = saved(rows, "urls")
    grams = _grams(rows.select("__row", "__said", "__fold", "__text"), order)
    seen = lambda said: F.sum(((F.col("__said") == said) & (F.col("__fold") > 0)).cast("long"))
    counts = grams.groupBy("__gram").agg(F.coalesce(seen("allow"), F.lit(0)).alias("a"), F.coalesce(seen("block"), F.lit(0)).alias("r"))
    model = small(saved(log_ratios(saved(counts, "counts"), order), "model"), MODEL_ROWS)
    means = grams.select("__row", "__gram").join(model, "__gram").groupBy("__row").agg(F.avg("__ratio").alias("score"))
    scored = rows.drop("__text").join(means, "__row", "left").withColumn("score", F.coalesce("score", F.lit(0.0)))
    scored = saved(scored, "scores")
    threshold = one_row(_threshold(scored)).getField("threshold")
    said = F.when(F.col("score") >= threshold, F.lit("allow")).otherwise(F.lit("block"))
    return scored.select(
        F.col("__key").alias(key),
        F.col("__host").alias("host"),
        F.col("__path").alias("path"),
        F.col("__rule").alias("rule"),
        F.coalesce("__said", said).alias("verdict"),
        "score",
        threshold.alias("threshold"),
    )
