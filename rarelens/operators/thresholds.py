"""Threshold policies read from a score curve, all groups in one aggregation.

Ties always resolve to the lowest threshold. Undefined metric values (NULL) never win.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rarelens.functions import rates
from rarelens.operators.curves import with_counts

# Fixed values
DEFAULT_RECALL_TARGET = 0.90
DEFAULT_PRECISION_TARGET = 0.90
DEFAULT_POLICY_PRECISION = 0.80
DEFAULT_FP_COST = 1.0
DEFAULT_FN_COST = 20.0

_CHOSEN = ("threshold", "precision", "recall", "tp", "fp", "tn", "fn")


def _sizes() -> list[Column]:
    return [F.max("positives").alias("_p"), F.max("n").alias("_n")]


def _pick(best: Column, when: Column | None = None) -> Column:
    """The curve point with the largest `best`, then the lowest threshold, among the rows where `when` holds.

    The point is its own sort key, so each row builds one small struct; everything else follows from its counts.
    """
    point = F.struct(best.alias("best"), (-F.col("threshold")).alias("low"), F.col("tp").alias("tp"),
                     F.col("n_at").alias("n_at"))
    return F.max(F.when(best.isNotNull() if when is None else best.isNotNull() & when, point))


def _point(picked: Column) -> Column:
    """A picked point as struct(threshold, precision, recall, tp, fp, tn, fn), given `_p` and `_n`."""
    tp, n_at, p, n = picked["tp"], picked["n_at"], F.col("_p"), F.col("_n")
    full = F.struct(
        (-picked["low"]).alias("threshold"), rates.ratio(tp, n_at).alias("precision"), rates.ratio(tp, p).alias("recall"),
        tp.alias("tp"), (n_at - tp).alias("fp"), (n - n_at - (p - tp)).alias("tn"), (p - tp).alias("fn"))
    return F.when(picked.isNotNull(), full)


def _row(aggregated: DataFrame, by: Sequence[str], picked: Column, *more: Column) -> DataFrame:
    named = aggregated.withColumn("_point", _point(picked))
    return named.select(*by, *[F.col(f"_point.{c}").alias(c) for c in _CHOSEN], *more)


def recall_target(curve: DataFrame, by: Sequence[str] = (), target: float = DEFAULT_RECALL_TARGET) -> DataFrame:
    """Most precise threshold whose recall reaches the target; otherwise the most sensitive one."""
    reached = F.col("recall") >= target
    agg = with_counts(curve).groupBy(*by).agg(
        _pick(F.col("precision"), reached).alias("hit"), _pick(F.col("recall")).alias("fallback"), *_sizes())
    return _row(agg, by, F.coalesce("hit", "fallback"), F.col("hit").isNotNull().alias("meets_target"))


def max_f_beta(curve: DataFrame, by: Sequence[str] = (), beta: float = 2.0,
               undefined_as_zero: bool = True) -> DataFrame:
    """Threshold with the largest F-beta. `undefined_as_zero` keeps rows with P=R=0 in the running at 0."""
    f = rates.f_beta if undefined_as_zero else rates.f_beta_or_null
    value = f(F.col("precision"), F.col("recall"), beta)
    agg = with_counts(curve).groupBy(*by).agg(_pick(value).alias("pick"), *_sizes())
    return _row(agg, by, F.col("pick"), F.col("pick.best").alias("f_beta"))


def precision_or_null(curve: DataFrame, by: Sequence[str] = (),
                      target: float = DEFAULT_PRECISION_TARGET) -> DataFrame:
    """Largest recall among thresholds with enough precision; NULLs and a note when there are none."""
    enough = F.col("precision") >= target
    agg = with_counts(curve).groupBy(*by).agg(_pick(F.col("recall"), enough).alias("pick"), *_sizes())
    note = F.when(F.col("pick").isNull(), F.lit("no threshold reaches the target precision"))
    return _row(agg, by, F.col("pick"), F.lit(float(target)).alias("target_precision"), note.alias("note"))


def precision_or_best(curve: DataFrame, by: Sequence[str] = (),
                      target: float = DEFAULT_PRECISION_TARGET) -> DataFrame:
    """Largest recall among thresholds with enough precision; otherwise the most precise threshold."""
    enough = F.col("precision") >= target
    agg = with_counts(curve).groupBy(*by).agg(
        _pick(F.col("recall"), enough).alias("hit"), _pick(F.col("precision")).alias("fallback"), *_sizes())
    return _row(agg, by, F.coalesce("hit", "fallback"), F.col("hit").isNotNull().alias("meets_constraint"))


def smallest_precise(curve: DataFrame, by: Sequence[str] = (),
                     target: float = DEFAULT_POLICY_PRECISION) -> DataFrame:
    """Smallest threshold with enough precision; otherwise the most precise threshold."""
    enough = F.col("precision") >= target
    agg = with_counts(curve).groupBy(*by).agg(
        _pick(F.lit(0.0), enough).alias("hit"), _pick(F.col("precision")).alias("fallback"), *_sizes())
    return _row(agg, by, F.coalesce("hit", "fallback"), F.col("hit").isNotNull().alias("meets_constraint"))


def min_cost(curve: DataFrame, by: Sequence[str] = (), fp_cost: float = DEFAULT_FP_COST,
             fn_cost: float = DEFAULT_FN_COST) -> DataFrame:
    """Cheapest distinct score: fp_cost * FP + fn_cost * FN, straight from the curve's counts."""
    cost = rates.Confusion.of().cost(fp_cost, fn_cost)
    agg = with_counts(curve).groupBy(*by).agg(_pick(-cost).alias("pick"), *_sizes())
    return _row(agg, by, F.col("pick"), (-F.col("pick.best")).alias("cost"))


POLICIES: dict[str, Callable[..., DataFrame]] = {
    "max_f1": partial(max_f_beta, beta=1.0, undefined_as_zero=False),
    "max_fbeta": partial(max_f_beta, undefined_as_zero=False),
    "precision_constraint": smallest_precise,
    "cost_based": min_cost,
    "recall_target": recall_target,
    "precision_or_null": precision_or_null,
    "precision_or_best": precision_or_best,
}


def register_policy(name: str, policy: Callable[..., DataFrame]) -> None:
    """Add a policy: a function of (curve, by, **options) returning one row per group with `threshold`."""
    POLICIES[name] = policy


def select_threshold(curve: DataFrame, policy: str, by: Sequence[str] = (), **options) -> DataFrame:
    if policy not in POLICIES:
        raise ValueError(f"unknown policy {policy!r}; known: {sorted(POLICIES)}")
    chosen = POLICIES[policy](curve, by, **options)
    return chosen.select(*by, F.lit(policy).alias("policy"), *[c for c in chosen.columns if c not in by])


def all_policies(curve: DataFrame, by: Sequence[str] = (), beta: float = 2.0,
                 precision_min: float = DEFAULT_POLICY_PRECISION, fp_cost: float = DEFAULT_FP_COST,
                 fn_cost: float = DEFAULT_FN_COST) -> DataFrame:
    """The four serving policies side by side: one aggregation of the curve, one row per policy."""
    p, r = F.col("precision"), F.col("recall")
    cost = rates.Confusion.of().cost(fp_cost, fn_cost)
    enough = p >= precision_min
    agg = with_counts(curve).groupBy(*by).agg(
        _pick(rates.f_beta_or_null(p, r, 1.0)).alias("max_f1"),
        _pick(rates.f_beta_or_null(p, r, beta)).alias("max_fbeta"),
        F.coalesce(_pick(F.lit(0.0), enough), _pick(p)).alias("precision_constraint"),
        _pick(-cost).alias("cost_based"), *_sizes())
    names = ("max_f1", "max_fbeta", "precision_constraint", "cost_based")
    stacked = F.explode(F.array(*[F.struct(F.lit(n).alias("policy"), _point(F.col(n)).alias("point")) for n in names]))
    return agg.select(*by, stacked.alias("_p")).select(
        *by, "_p.policy", *[F.col(f"_p.point.{c}").alias(c) for c in _CHOSEN])


def recall_at_precision(curve: DataFrame, targets: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Best recall at each precision target; the closing point (P=1, R=0) makes 0.0 the floor."""
    best = [F.coalesce(F.max(F.when(F.col("precision") >= t, F.col("recall"))), F.lit(0.0)) for t in targets]
    return _stack_targets(with_counts(curve), by, targets, best, "recall")


def precision_at_recall(curve: DataFrame, targets: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Best precision at each recall target; 1.0 at target zero (the closing point), 0.0 if unreachable."""
    best = [F.lit(1.0) if t <= 0 else
            F.coalesce(F.max(F.when(F.col("recall") >= t, F.col("precision"))), F.lit(0.0)) for t in targets]
    return _stack_targets(with_counts(curve), by, targets, best, "precision")


def recall_at_fpr(curve: DataFrame, limits: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Best recall while the false-positive rate stays within each limit."""
    fpr = rates.ratio(F.col("fp"), F.col("fp") + F.col("tn"))
    best = [F.coalesce(F.max(F.when(fpr <= x, F.col("recall"))), F.lit(0.0)) for x in limits]
    return _stack_targets(with_counts(curve), by, limits, best, "recall")


def _stack_targets(points: DataFrame, by: Sequence[str], targets: Sequence[float],
                   best: Sequence[Column], name: str) -> DataFrame:
    agg = points.groupBy(*by).agg(*[b.alias(f"_t{i}") for i, b in enumerate(best)])
    items = [F.struct(F.lit(float(t)).alias("target"), F.col(f"_t{i}").alias(name)) for i, t in enumerate(targets)]
    return agg.select(*by, F.explode(F.array(*items)).alias("_i")).select(*by, "_i.*")


def at_top_share(curve: DataFrame, shares: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Precision and recall when alerting on the top share of rows, never splitting tied scores.

    The cut is the lowest distinct score whose cumulative row count stays within share * n.
    """
    points = with_counts(curve)
    picks = []
    for i, share in enumerate(shares):
        inside = F.col("n_at") <= F.col("n") * F.lit(float(share))
        picks.append(F.max_by(F.struct("threshold", "n_at", "tp", "precision", "recall"),
                              F.when(inside, F.col("n_at"))).alias(f"_t{i}"))
    agg = points.groupBy(*by).agg(*picks)
    items = [F.struct(F.lit(float(s)).alias("share"), F.col(f"_t{i}").alias("cut")) for i, s in enumerate(shares)]
    cut = F.col("_i.cut")
    return agg.select(*by, F.explode(F.array(*items)).alias("_i")).select(
        *by, F.col("_i.share").alias("share"), cut["threshold"].alias("threshold"),
        F.coalesce(cut["n_at"], F.lit(0)).alias("alerts"), F.coalesce(cut["tp"], F.lit(0)).alias("tp"),
        F.coalesce(cut["precision"], F.lit(0.0)).alias("precision"),
        F.coalesce(cut["recall"], F.lit(0.0)).alias("recall"))
