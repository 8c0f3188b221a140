"""Grid sweeps: all thresholds evaluated in one scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rarelens.functions.rates import Confusion
from rarelens.operators.curves import as_scored
from rarelens.operators.ordered import bucketize, double_array

# Fixed values
GRID_START = 0.01
GRID_STOP = 0.99
GRID_POINTS = 101
SCENARIOS = (0.3, 0.5, 0.7)
STABILITY_DELTA = 0.02


def threshold_grid(points: int = GRID_POINTS) -> list[float]:
    return [float(t) for t in np.linspace(GRID_START, GRID_STOP, points)]


def counts_at(df: DataFrame, thresholds: Sequence[float], label: str = "label", score: str = "score",
              by: Sequence[str] = ()) -> DataFrame:
    """by + (threshold, tp, fp, tn, fn) for every threshold from a single aggregation.

    Each row falls into the cell numbered by how many thresholds it reaches; a suffix sum over the
    len(thresholds)+1 cells of a group turns cell counts into confusion counts.
    """
    grid = sorted({float(t) for t in thresholds})
    cells = bucketize(as_scored(df, label, score, by), "score", grid, "_cell")
    counted = cells.groupBy(*by, "_cell").agg(F.sum("label").alias("_pos"), F.count(F.lit(1)).alias("_cnt"))
    summed = counted.groupBy(*by).agg(
        F.coalesce(F.sum("_pos"), F.lit(0)).alias("_p"), F.coalesce(F.sum("_cnt"), F.lit(0)).alias("_n"),
        F.collect_list(F.struct("_cell", "_pos", "_cnt")).alias("_cells"))
    rung = F.col("_rank") + 1

    def reaching(field: str):
        kept = F.filter(F.col("_cells"), lambda c: c["_cell"] >= rung)
        return F.aggregate(kept, F.lit(0).cast("bigint"), lambda acc, c: acc + c[field])

    out = summed.select(*by, "_p", "_n", "_cells", 
                        F.posexplode(double_array(grid)).alias("_rank", "threshold")).select(
        *by, "_p", "_n", "threshold", reaching("_pos").alias("tp"), reaching("_cnt").alias("_at"))
    return out.select(
        *by, "threshold", "tp", (F.col("_at") - F.col("tp")).alias("fp"),
        (F.col("_n") - F.col("_at") - (F.col("_p") - F.col("tp"))).alias("tn"),
        (F.col("_p") - F.col("tp")).alias("fn"))


def sweep(df: DataFrame, thresholds: Sequence[float] | None = None, label: str = "label", score: str = "score",
          by: Sequence[str] = (), fp_cost: float = 1.0, fn_cost: float = 20.0) -> DataFrame:
    """The 11-column sweep table."""
    c = Confusion.of()
    return counts_at(df, thresholds or threshold_grid(), label, score, by).select(
        *by, "threshold", c.precision.alias("precision"), c.recall.alias("recall"), c.f1.alias("f1"),
        c.tnr.alias("specificity"), c.balanced_accuracy.alias("balanced_accuracy"),
        "tp", "fp", "tn", "fn", c.cost_per_row(fp_cost, fn_cost).alias("cost_per_tx"))


def scenarios(df: DataFrame, thresholds: Sequence[float] = SCENARIOS, **options) -> DataFrame:
    """The sweep at a few fixed operating points."""
    return sweep(df, thresholds, **options)


def pick_from_sweep(swept: DataFrame, mode: str, by: Sequence[str] = ()) -> DataFrame:
    """Best sweep row by "f1", "youden" (balanced accuracy) or "cost"; "none" picks nothing."""
    goal = {"f1": F.col("f1"), "youden": F.col("balanced_accuracy"), "cost": -F.col("cost_per_tx")}
    others = [c for c in swept.columns if c not in by]
    if mode == "none":
        empty = [F.lit(None).cast(swept.schema[c].dataType).alias(c) for c in others]
        return swept.select(*by, F.lit(mode).alias("mode"), *empty).distinct()
    if mode not in goal:
        raise ValueError(f"unknown mode {mode!r}")
    best = F.max_by(F.struct(*others), F.struct(goal[mode], -F.col("threshold")))
    return swept.groupBy(*by).agg(best.alias("_b")).select(*by, F.lit(mode).alias("mode"), "_b.*")


def nearest_row(swept: DataFrame, target: float, by: Sequence[str] = ()) -> DataFrame:
    """The sweep row whose threshold is closest to `target` (lower one on ties)."""
    others = [c for c in swept.columns if c not in by]
    key = F.struct(F.abs(F.col("threshold") - F.lit(float(target))), F.col("threshold"))
    return swept.groupBy(*by).agg(F.min_by(F.struct(*others), key).alias("_b")).select(*by, "_b.*")


def stability(swept: DataFrame, mode: str = "cost", by: Sequence[str] = (),
              delta: float = STABILITY_DELTA) -> DataFrame:
    """The picked row beside its neighbours at +/- delta, to see how sharply the policy sits."""
    goal = {"f1": F.col("f1"), "youden": F.col("balanced_accuracy"), "cost": -F.col("cost_per_tx")}[mode]
    group = Window.partitionBy(*by)  # a group is one sweep: a row per threshold
    row = F.struct("threshold", "precision", "recall", "tp", "fp", "fn")
    chosen = swept.withColumn("_pick", F.max_by(row, F.struct(goal, -F.col("threshold"))).over(group))
    at = F.col("_pick.threshold")

    def near(target):
        return F.min_by(row, F.struct(F.abs(F.col("threshold") - target), F.col("threshold")))

    agg = chosen.groupBy(*by, "_pick").agg(
        near(F.greatest(F.lit(GRID_START), at - delta)).alias("_left"),
        near(F.least(F.lit(GRID_STOP), at + delta)).alias("_right"))
    sides = [("_pick", ""), ("_left", "_left"), ("_right", "_right")]
    return agg.select(*by, *[F.col(f"{s}.{c}").alias(c + suffix) for s, suffix in sides
                             for c in ("threshold", "precision", "recall", "tp", "fp", "fn")])


def compare_policies(df: DataFrame, policies: Mapping[str, float], label: str = "label", score: str = "score",
                     by: Sequence[str] = (), fp_cost: float = 1.0, fn_cost: float = 20.0,
                     goals: Mapping[str, tuple[str, float]] | None = None) -> DataFrame:
    """Named thresholds side by side with alert volumes and goal flags."""
    goals = goals if goals is not None else {
        "meets_recall_090": ("recall", 0.90), "meets_precision_010": ("precision", 0.10),
        "meets_precision_080": ("precision", 0.80)}
    c = Confusion.of()
    counted = counts_at(df, list(policies.values()), label, score, by)
    names = F.array(*[F.struct(F.lit(n).alias("policy_name"), F.lit(float(t)).alias("t"))
                      for n, t in policies.items()])
    named = counted.withColumn("_p", F.explode(F.filter(names, lambda p: p["t"] == F.col("threshold"))))
    rate = {"recall": c.recall, "precision": c.precision}
    per_10k = lambda x: F.try_divide(x.cast("double") * 10000.0, c.total.cast("double"))
    return named.select(
        *by, "_p.policy_name", "threshold", c.precision.alias("precision"), c.recall.alias("recall"),
        c.f1.alias("f1"), "tp", "fp", "fn", "tn", c.alerts.alias("alerts"),
        F.try_divide(c.alerts.cast("double"), c.total.cast("double")).alias("alert_rate"),
        per_10k(c.alerts).alias("alerts_per_10k"), per_10k(F.col("fn")).alias("missed_per_10k"),
        c.cost_per_row(fp_cost, fn_cost).alias("cost_per_tx"),
        *[(rate[m] >= goal).alias(name) for name, (m, goal) in goals.items()])
