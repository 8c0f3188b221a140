"""The score curve: one row per distinct score with everything at or above it counted.

Every ranking metric and threshold policy reads this one table. It costs a group-by on the score (map-side
combined, so ties shrink before the shuffle) and one more shuffle for the running totals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rarelens.functions import rates
from rarelens.operators.ordered import range_buckets, running_totals


def as_scored(df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = (),
              keep: Sequence[str] = ()) -> DataFrame:
    """Enforce the scored contract: label 0/1, score a finite-or-infinite number, group columns present.

    A violating row raises when it is read; nothing is dropped silently.
    """
    y, s = F.col(label).cast("int"), F.col(score).cast("double")
    fail = lambda text: F.raise_error(F.lit(text))
    return df.select(
        *[F.when(F.col(c).isNull(), fail(f"group column {c} is NULL")).otherwise(F.col(c)).alias(c) for c in by],
        *keep,
        F.when(y.isin(0, 1), y).otherwise(fail("label must be 0 or 1")).alias("label"),
        F.when(s.isNull() | F.isnan(s), fail("score must be a number")).otherwise(s).alias("score"),
    )


def score_curve(df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = (),
                buckets: int | None = None) -> DataFrame:
    """by + (threshold, pos, cnt, tp, n_at, positives, n).

    `pos`/`cnt` count rows exactly at the threshold, `tp`/`n_at` those at or above it.
    """
    scored = as_scored(df, label, score, by)
    plan = range_buckets(scored, ["score"], by, buckets)
    points = plan.apply(scored).groupBy(*by, "_bucket_score", "score").agg(
        F.sum("label").alias("pos"), F.count(F.lit(1)).alias("cnt"))
    totals = running_totals(points, by, "_bucket_score", "score", ["pos", "cnt"], descending=True,
                            few_offsets=plan.few_offsets("score"))
    return totals.select(
        *by, F.col("score").alias("threshold"), "pos", "cnt",
        F.col("pos_upto").alias("tp"), F.col("cnt_upto").alias("n_at"),
        F.col("pos_total").alias("positives"), F.col("cnt_total").alias("n"),
    )


def with_counts(curve: DataFrame) -> DataFrame:
    """Add fp, fn, tn, precision and recall to a curve."""
    tp, n_at, p, n = (F.col(c) for c in ("tp", "n_at", "positives", "n"))
    return curve.withColumns({
        "fp": n_at - tp, "fn": p - tp, "tn": n - n_at - (p - tp),
        "precision": rates.ratio(tp, n_at), "recall": rates.ratio(tp, p),
    })


def pr_curve(curve: DataFrame, by: Sequence[str] = (), terminal: bool = True) -> DataFrame:
    """by + (threshold, precision, recall); `terminal` adds the closing point P=1, R=0 with no threshold."""
    points = with_counts(curve).select(*by, "threshold", "precision", "recall")
    if not terminal:
        return points
    groups = curve.select(*by, F.lit(1).alias("_g")).distinct()
    last = groups.select(*by, F.lit(None).cast("double").alias("threshold"),
                         F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return points.unionByName(last)


def policy_sweep(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """by + (threshold, precision, recall, f1, f2); F values are NULL where undefined."""
    p, r = F.col("precision"), F.col("recall")
    return with_counts(curve).select(
        *by, "threshold", "precision", "recall",
        rates.f_beta_or_null(p, r, 1.0).alias("f1"), rates.f_beta_or_null(p, r, 2.0).alias("f2"))


def roc_curve(curve: DataFrame, by: Sequence[str] = (), origin: bool = True) -> DataFrame:
    """by + (threshold, fpr, tpr); `origin` adds the (0, 0) point with no threshold."""
    fp, neg = F.col("n_at") - F.col("tp"), F.col("n") - F.col("positives")
    points = curve.select(*by, "threshold", rates.ratio(fp, neg).alias("fpr"),
                          rates.ratio(F.col("tp"), F.col("positives")).alias("tpr"))
    if not origin:
        return points
    groups = curve.select(*by, F.lit(1).alias("_g")).distinct()
    first = groups.select(*by, F.lit(None).cast("double").alias("threshold"),
                          F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.unionByName(first)


def average_precision_expr():
    """Step-sum average precision over curve rows; NULL without positives."""
    step = F.col("pos") / F.col("positives").cast("double") * (F.col("tp") / F.col("n_at").cast("double"))
    return F.sum(F.when(F.col("positives") > 0, step))


def roc_auc_expr():
    """Area under the ROC curve with ties counted half; NULL when a class is missing."""
    above, ties = (F.col("tp") - F.col("pos")).cast("double"), F.col("pos") / F.lit(2.0)
    negatives = (F.col("cnt") - F.col("pos")).cast("double")
    area = F.sum(negatives * (above + ties))
    pairs = F.max(F.col("positives")).cast("double") * F.max(F.col("n") - F.col("positives")).cast("double")
    return F.try_divide(area, F.when(pairs > 0, pairs))


def ranking_metrics(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """by + (n, pos, neg, pr_auc, roc_auc, thresholds) from one pass over the curve."""
    return curve.groupBy(*by).agg(
        F.max("n").alias("n"), F.max("positives").alias("pos"),
        F.max(F.col("n") - F.col("positives")).alias("neg"),
        average_precision_expr().alias("pr_auc"), roc_auc_expr().alias("roc_auc"),
        F.count(F.lit(1)).alias("thresholds"),
    )


def average_precision(df: DataFrame, label: str = "label", score: str = "score",
                      by: Sequence[str] = ()) -> DataFrame:
    return ranking_metrics(score_curve(df, label, score, by), by).select(*by, F.col("pr_auc").alias("average_precision"))


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    return ranking_metrics(score_curve(df, label, score, by), by).select(*by, "roc_auc")
