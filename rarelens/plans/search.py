"""Cross-validation, grid and random search, refits and A/B comparisons.

Search tables hold one row per parameter set; only those small tables are built on the driver. Fitting and
scoring run on Spark, and folds are assigned in place (`operators.splits.k_folds`).
"""

from __future__ import annotations

import itertools
import random
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from typing import Any

from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rarelens.contracts import ContractError
from rarelens.operators.curves import average_precision
from rarelens.operators.evaluation import evaluate
from rarelens.operators.profile import run_summary
from rarelens.operators.splits import k_folds
from rarelens.plans.fitonly import SpecEstimator
from rarelens.plans.locking import choose
from rarelens.plans.models import LABEL, AveragePrecisionEvaluator, ModelSpec, score_model
from rarelens.sources.reports import params_json, result_rows, stack_results

Params = Mapping[str, Any]


def grid(options: Mapping[str, Sequence[Any]]) -> list[dict[str, Any]]:
    """Every combination, in the order of the option lists."""
    return [dict(zip(options, values)) for values in itertools.product(*options.values())]


def draw(options: Mapping[str, Sequence[Any]], n: int, seed: int = 42) -> list[dict[str, Any]]:
    """n distinct combinations drawn with a seed (all of them when there are no more than n)."""
    sizes = [len(v) for v in options.values()]
    total = 1
    for s in sizes:
        total *= s
    picks = sorted(random.Random(seed).sample(range(total), min(n, total)))
    out = []
    for code in picks:
        one = {}
        for (name, values), size in zip(options.items(), sizes):
            code, at = divmod(code, size)
            one[name] = values[at]
        out.append(one)
    return out


@dataclass
class SearchResult:
    table: DataFrame
    best_params: dict[str, Any]
    best_score: float
    model: CrossValidatorModel
    runtime_s: float


def cross_validate(spec: ModelSpec, df: DataFrame, keys: Sequence[str], candidates: Sequence[Params],
                   folds: int = 3, evaluator=None, parallelism: int = 4, seed: int = 42) -> SearchResult:
    """Score every candidate with stratified folds. Candidates name parameters of the spec's family or of its Spark classifier.

    Class weights, the strength that `C` stands for and over-sampling come from each training fold alone. The result table has (candidate, params_json, mean_test_score, std_test_score, rank), best first.
    """
    folded = k_folds(df, spec.target, keys, folds, "_fold", seed)
    drawn = [spec.resample["key"]] if spec.resample is not None and spec.resample["key"] not in spec.features else []
    table = folded.select(*spec.features, *drawn, spec.target, "_fold", F.col(spec.target).cast("double").alias(LABEL))
    estimator = SpecEstimator(spec)
    search = CrossValidator(estimator=estimator, estimatorParamMaps=estimator.maps(list(candidates)),
                            evaluator=evaluator or AveragePrecisionEvaluator(), numFolds=folds, foldCol="_fold",
                            parallelism=parallelism, seed=seed)
    table = table.persist()
    start = time.perf_counter()
    try:
        fitted = search.fit(table)
    finally:
        table.unpersist()
    took = time.perf_counter() - start
    scores, stds = [float(s) for s in fitted.avgMetrics], [float(s) for s in fitted.stdMetrics]
    ranks = [1 + sum(other > s for other in scores) for s in scores]
    rows = [(i, params_json(c), scores[i], stds[i], ranks[i]) for i, c in enumerate(candidates)]
    out = df.sparkSession.createDataFrame(
        rows, "candidate int, params_json string, mean_test_score double, std_test_score double, rank int")
    best = min(range(len(rows)), key=lambda i: (ranks[i], i))
    return SearchResult(out.orderBy("rank", "candidate"), dict(candidates[best]), scores[best], fitted, took)


def cross_val_score(spec: ModelSpec, df: DataFrame, keys: Sequence[str], folds: int = 5, seed: int = 42,
                    resample: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(fold, average_precision): train on the other folds (resampled only there), score the held-out one."""
    folded = k_folds(df, spec.target, keys, folds, "_fold", seed)
    parts = []
    for i in range(folds):
        train = folded.where(F.col("_fold") != i).drop("_fold")
        model = spec.fit(resample(train) if resample else train)
        scored = score_model(model, folded.where(F.col("_fold") == i), spec.target)
        parts.append(average_precision(scored).withColumn("fold", F.lit(i)))
    return stack_results(parts).select("fold", "average_precision")


def score_spread(fold_scores: DataFrame) -> DataFrame:
    """Mean and population deviation over folds."""
    return fold_scores.agg(F.avg("average_precision").alias("mean"), F.stddev_pop("average_precision").alias("std"))


def pick_c(spec: ModelSpec, train: DataFrame, validation: DataFrame, values: Sequence[float]) -> tuple[float, DataFrame]:
    """One-dimensional search over C by average precision; the first of equal values wins."""
    rows, best = [], None
    for c in values:
        model = replace(spec, params={**spec.params, "C": c}).fit(train)
        ap = average_precision(score_model(model, validation, spec.target)).first()[0]
        ap = float(ap) if ap is not None else 0.0
        rows.append((float(c), ap))
        if best is None or ap > best[1]:
            best = (c, ap)
    table = train.sparkSession.createDataFrame(rows, "C double, average_precision double")
    return best[0], table


def top_params(result: SearchResult, candidates: Sequence[Params], k: int = 3) -> list[dict[str, Any]]:
    """The k best-ranked parameter sets (rank, then candidate order)."""
    order = [r["candidate"] for r in result.table.orderBy("rank", "candidate").limit(k).collect()]
    return [dict(candidates[i]) for i in order]


def refit_top(spec: ModelSpec, params_list: Sequence[Params], train: DataFrame, validation: DataFrame,
              test: DataFrame, precision_target: float | None = 0.90, name: str | None = None) -> DataFrame:
    """Refit each parameter set; choose thresholds on validation; report validation and test rows.

    Policies: largest F2, and (when reachable) precision at least `precision_target`.
    """
    spark, parts = train.sparkSession, []
    for i, params in enumerate(params_list, start=1):
        one = replace(spec, params={**spec.params, **params})
        start = time.perf_counter()
        model = one.fit(train)
        took = time.perf_counter() - start
        val, held = score_model(model, validation, spec.target), score_model(model, test, spec.target)
        wanted = [("maxF2", "max_fbeta", {"undefined_as_zero": True})]
        if precision_target is not None:
            wanted.append((f"precision>={precision_target}", "precision_or_null", {"target": precision_target}))
        for tag, policy, options in wanted:
            try:
                locked = choose(val, policy, **options)
            except ContractError:
                continue  # no validation threshold reaches the target: nothing to report for this policy
            noted = dict(params)
            if policy == "precision_or_null":
                noted["precision_constraint"] = {"target": precision_target, "precision": locked.details["precision"],
                                                 "recall": locked.details["recall"]}
            for stage, scored in (("valid", val), ("test", held)):
                parts.append(result_rows(spark, name or str(spec.family), f"{stage}_top{i}_{tag}", noted,
                                         evaluate(scored, locked.threshold), took))
    return stack_results(parts)


def ab_test(spec: ModelSpec, variants: Mapping[str, Sequence[str]], splits: Mapping[str, DataFrame],
            seeds: Sequence[int], precision_target: float = 0.90) -> tuple[DataFrame, DataFrame]:
    """Same splits, different feature sets, several seeds: (rows per seed and run, mean/std per run)."""
    parts = []
    for seed in seeds:
        for run, features in variants.items():
            one = replace(spec, features=list(features), params={**spec.params, "seed": seed})
            model = one.fit(splits["train"])
            locked = choose(score_model(model, splits["val"], spec.target), "precision_or_best", target=precision_target)
            metrics = evaluate(score_model(model, splits["test"], spec.target), locked.threshold)
            parts.append(metrics.select(
                F.lit(seed).alias("seed"), F.lit(run).alias("run"),
                F.lit(bool(locked.details["meets_constraint"])).alias("meets_constraint"),
                F.lit(float(locked.details["precision"])).alias("val_precision"),
                F.lit(float(locked.details["recall"])).alias("val_recall"),
                "threshold", "pr_auc", "roc_auc", "precision", "recall", "tp", "fp", "tn", "fn"))
    rows = stack_results(parts)
    return rows, run_summary(rows, ["pr_auc", "roc_auc", "precision", "recall", "tp", "fp", "fn"])


def score_models(models: Mapping[str, Any], df: DataFrame, target: str = "Class") -> DataFrame:
    """All models' scores stacked as (model, label, score), so one evaluation job covers them."""
    return stack_results([score_model(m, df, target).withColumn("model", F.lit(n)) for n, m in models.items()])


