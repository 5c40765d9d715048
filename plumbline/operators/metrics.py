"""Scores of predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.columns import as_list, col, require
from ..plans.running import ROWS_PER_SORT, range_splits, running_totals
from ..plans.stats import one_row
from ..plans.storage import written


def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: mae, mse, r2."""
    y, p = col(label).cast("double"), col(prediction).cast("double")
    both = df.where(y.isNotNull() & p.isNotNull())
    return both.agg(
        F.avg(F.abs(y - p)).alias("mae"),
        F.avg((y - p) * (y - p)).alias("mse"),
        F.var_pop(y).alias("__var"),
    ).select("mae", "mse", (1 - F.try_divide(F.col("mse"), F.col("__var"))).alias("r2"))


def classification_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction", positive: float = 1
) -> DataFrame:
    """One row: accuracy, and recall of the positive class."""
    y, p = col(label), col(prediction)
    both = df.where(y.isNotNull() & p.isNotNull())
    return both.agg(
        F.avg((y == p).cast("int")).alias("accuracy"),
        F.try_divide(
            F.count_if((y == positive) & (p == positive)).cast("double"), F.count_if(y == positive)
        ).alias("recall"),
    )


def _score_counts(df: DataFrame, label: str, score: str, rows_per_task: int) -> tuple[DataFrame, bool]:
    """Positives and negatives per distinct score and above it; were ranges needed?

    Scores may come from a model over the whole table. They are made once: what is
    written and read again is a row per distinct score.
    """
    require(df, [label, score])
    rows = df.where(col(label).isNotNull() & col(score).isNotNull()).select(
        col(score).cast("double").alias("score"), (col(label) == 1).alias("__hit")
    )
    totals = {"pos": F.count_if(F.col("__hit")), "neg": F.count_if(~F.col("__hit"))}
    counts = written(rows.groupBy("score").agg(*[total.alias(name) for name, total in totals.items()]), "scores")
    splits = range_splits(counts, "score", rows_per_task)
    return running_totals(counts, "score", list(totals), splits), bool(splits)


def roc_curve(
    df: DataFrame, label: str = "label", score: str = "score", drop_intermediate: bool = False,
    rows_per_task: int = ROWS_PER_SORT,
) -> DataFrame:
    """``(threshold, fpr, tpr, step_fpr, step_tpr)``, one row per distinct score.

    The start (0, 0) has no threshold. Rates are NULL if a class is absent.
    The steps lead from the point before, so an area needs no ordering.
    ``drop_intermediate`` leaves out points where the curve goes straight on,
    and with them the steps.
    """
    counts, ranged = _score_counts(df, label, score, rows_per_task)
    totals = one_row(
        df.where(col(label).isNotNull() & col(score).isNotNull()).agg(
            F.count_if(col(label) == 1).cast("double").alias("pos"),
            F.count_if(col(label) != 1).cast("double").alias("neg"),
        )
    )
    share = lambda n, side: F.try_divide(n.cast("double"), totals.getField(side))
    if drop_intermediate:
        counts = _drop_straight(counts, ranged)
    points = counts.select(
        F.col("score").alias("threshold"),
        share(F.col("neg_before") + F.col("neg"), "neg").alias("fpr"),
        share(F.col("pos_before") + F.col("pos"), "pos").alias("tpr"),
        share(F.col("neg"), "neg").alias("step_fpr"),
        share(F.col("pos"), "pos").alias("step_tpr"),
    )
    start = df.sparkSession.createDataFrame(
        [(None, 0.0, 0.0, 0.0, 0.0)], ", ".join(f"{c} double" for c in points.columns)
    )
    curve = start.unionByName(points)
    return curve.drop("step_fpr", "step_tpr") if drop_intermediate else curve


def _drop_straight(counts: DataFrame, ranged: bool) -> DataFrame:
    """Keep the first and last point and those where the next step differs.

    The next lower score is looked up inside its range of scores, and at the
    end of a range in the short table of how each range starts.
    """
    step = F.struct("pos", "neg")
    inside = Window.partitionBy("__range").orderBy(F.desc("score"))
    stepped = counts.withColumn("__next", F.lead(step).over(inside))
    if ranged:
        starts = counts.groupBy("__range").agg(F.max_by(step, "score").alias("start"))
        following = starts.select(
            "__range", F.lead("start").over(Window.orderBy(F.desc("__range"))).alias("__following")
        )
        stepped = stepped.join(F.broadcast(following), "__range").withColumn(
            "__next", F.coalesce("__next", "__following")
        )
    first = (F.col("pos_before") == 0) & (F.col("neg_before") == 0)
    return stepped.where(first | F.col("__next").isNull() | (F.col("__next") != step))


def auc_trapezoid(curve: DataFrame) -> DataFrame:
    """``(auc)`` of a full ROC curve by the trapezoid rule; NULL if a rate is."""
    part = F.col("step_fpr") * (F.col("tpr") - F.col("step_tpr") / 2)
    return curve.agg(F.when(F.count(part) == F.count("*"), F.sum(part)).alias("auc"))


def roc_auc(
    df: DataFrame, label: str = "label", score: str = "score", rows_per_task: int = ROWS_PER_SORT
) -> DataFrame:
    """``(auc)``: probability that a positive scores above a negative, ties half.

    The score is any number. NULL if a class is absent.
    """
    counts, _ = _score_counts(df, label, score, rows_per_task)
    won = F.sum(F.col("neg") * (F.col("pos_before") + F.col("pos") / 2))
    return counts.agg(
        F.try_divide(won, F.sum("pos").cast("double") * F.sum("neg").cast("double")).alias("auc")
    )


def candidate_auc(df: DataFrame, label: str, scores: str | Sequence[str], rows_per_task: int = ROWS_PER_SORT) -> DataFrame:
    """``(idx, candidate, auc)`` for several score columns, as input to a pick of the best."""
    out = None
    for i, s in enumerate(as_list(scores)):
        one = roc_auc(df, label, s, rows_per_task).select(
            F.lit(i).cast("bigint").alias("idx"), F.lit(s).alias("candidate"), "auc"
        )
        out = one if out is None else out.unionByName(one)
    return out
