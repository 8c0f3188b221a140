"""Metric bundles for scored tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rarelens.functions.rates import Confusion, ratio
from rarelens.operators.curves import (
    as_scored,
    average_precision_expr,
    ranking_metrics,
    roc_auc_expr,
    score_curve,
)
from rarelens.operators.ordered import double_array
from rarelens.operators.sweep import sweep, threshold_grid


def confusion(df: DataFrame, threshold: float, label: str = "label", score: str = "score",
              by: Sequence[str] = ()) -> DataFrame:
    """by + (tp, fp, tn, fn) at one threshold; an empty ungrouped input counts zero everywhere."""
    rows = as_scored(df, label, score, by)
    said, true = F.col("score") >= F.lit(float(threshold)), F.col("label") == 1
    count = lambda cond: F.count(F.when(cond, 1))
    return rows.groupBy(*by).agg(
        count(said & true).alias("tp"), count(said & ~true).alias("fp"),
        count(~said & ~true).alias("tn"), count(~said & true).alias("fn"))


def with_rates(counts: DataFrame) -> DataFrame:
    """Every confusion-derived rate added to tp/fp/tn/fn rows."""
    c = Confusion.of()
    return counts.withColumns({
        "tpr": c.recall, "fpr": c.fpr, "tnr": c.tnr, "fnr": c.fnr, "balanced_accuracy": c.balanced_accuracy,
        "precision": c.precision, "recall": c.recall, "f1": c.f1, "f2": c.f_beta(2.0), "mcc": c.mcc,
        "accuracy": c.accuracy, "specificity": c.tnr, "predicted_positives": c.alerts,
        "support_pos": F.col("tp") + F.col("fn"), "support_neg": F.col("tn") + F.col("fp")})


def evaluate(df: DataFrame, threshold: float, label: str = "label", score: str = "score",
             by: Sequence[str] = ()) -> DataFrame:
    """Locked evaluation: ranking metrics and the confusion at a given threshold, from one curve.

    The confusion falls out of the curve (the lowest distinct score at or above the threshold holds the
    counts), so the table is not scanned a second time.
    """
    curve = score_curve(df, label, score, by)
    reached = F.col("threshold") >= F.lit(float(threshold))
    tp = F.coalesce(F.max(F.when(reached, F.col("tp"))), F.lit(0))
    alerts = F.coalesce(F.max(F.when(reached, F.col("n_at"))), F.lit(0))
    agg = curve.groupBy(*by).agg(
        tp.alias("tp"), (alerts - tp).alias("fp"),
        F.coalesce(F.max("positives"), F.lit(0)).alias("pos"), F.coalesce(F.max("n"), F.lit(0)).alias("n"),
        average_precision_expr().alias("pr_auc"), roc_auc_expr().alias("roc_auc"))
    counts = agg.withColumns({
        "fn": F.col("pos") - F.col("tp"), "neg": F.col("n") - F.col("pos"),
        "tn": F.col("n") - F.col("pos") - F.col("fp")})
    c = Confusion.of()
    return counts.select(
        *by, F.lit(float(threshold)).alias("threshold"), c.precision.alias("precision"), c.recall.alias("recall"),
        c.f1.alias("f1"), c.f_beta(2.0).alias("f2"), c.mcc.alias("mcc"), "pr_auc", "roc_auc",
        "tp", "fp", "tn", "fn", "n", "pos", "neg")


def classification_report(df: DataFrame, threshold: float, label: str = "label", score: str = "score",
                          by: Sequence[str] = (), digits: int = 4) -> DataFrame:
    """Five rows: both classes, accuracy, macro and weighted averages."""
    pos = Confusion.of()
    neg = Confusion(tp=F.col("tn"), fp=F.col("fn"), tn=F.col("tp"), fn=F.col("fp"))
    n_pos, n_neg = F.col("tp") + F.col("fn"), F.col("tn") + F.col("fp")
    n = n_pos + n_neg

    def line(position, name, precision, recall, f1, support):
        return F.struct(F.lit(position).alias("position"), F.lit(name).alias("class"),
                        F.round(precision, digits).alias("precision"), F.round(recall, digits).alias("recall"),
                        F.round(f1, digits).alias("f1"), support.cast("bigint").alias("support"))

    macro = lambda f: (f(neg) + f(pos)) / 2.0
    weighted = lambda f: ratio(f(neg) * n_neg + f(pos) * n_pos, n)
    p, r, f1 = (lambda c: c.precision), (lambda c: c.recall), (lambda c: c.f1)
    nothing = F.lit(None).cast("double")
    lines = F.array(
        line(0, "0", p(neg), r(neg), f1(neg), n_neg), line(1, "1", p(pos), r(pos), f1(pos), n_pos),
        line(2, "accuracy", nothing, nothing, pos.accuracy, n),
        line(3, "macro avg", macro(p), macro(r), macro(f1), n),
        line(4, "weighted avg", weighted(p), weighted(r), weighted(f1), n))
    return confusion(df, threshold, label, score, by).select(*by, F.explode(lines).alias("_l")).select(*by, "_l.*")


def compare_models(df: DataFrame, model: str = "model", label: str = "label", score: str = "score",
                   thresholds: Sequence[float] | None = None, fp_cost: float = 1.0,
                   fn_cost: float = 20.0) -> DataFrame:
    """One row per model: ranking quality, metrics at 0.50 and at its cheapest grid threshold."""
    grid = list(thresholds or threshold_grid())
    swept = sweep(df, sorted({*grid, 0.5}), label, score, [model], fp_cost, fn_cost)
    fields = ("precision", "recall", "f1", "tp", "fp", "fn", "cost_per_tx")
    row = F.struct("threshold", *fields)
    cheapest = F.struct(-F.col("cost_per_tx"), -F.col("threshold"))
    on_grid = F.array_contains(double_array(grid), F.col("threshold"))
    picks = swept.groupBy(model).agg(
        F.max_by(row, F.when(F.col("threshold") == 0.5, 1)).alias("_half"),
        F.max_by(row, F.when(on_grid, cheapest)).alias("_best"))
    ranking = ranking_metrics(score_curve(df, label, score, [model]), [model])
    return ranking.join(picks, model).select(
        model, "roc_auc", "pr_auc", *[F.col(f"_half.{c}").alias(f"thr_0_50_{c}") for c in fields],
        F.col("_best.threshold").alias("thr_cost_best"), *[F.col(f"_best.{c}").alias(f"thr_cost_{c}") for c in fields])
