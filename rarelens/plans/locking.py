"""Choose on validation, evaluate on test: two functions that cannot be swapped."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rarelens.contracts import ContractError, ThresholdPolicy
from rarelens.operators.curves import score_curve
from rarelens.operators.evaluation import evaluate
from rarelens.operators.thresholds import select_threshold


def choose(validation: DataFrame, policy: str, label: str = "label", score: str = "score",
           artifact: str = "model", **options) -> ThresholdPolicy:
    """Select a threshold on the validation rows and lock it (one result row is read)."""
    row = select_threshold(score_curve(validation, label, score), policy, **options).first()
    if row is None or row["threshold"] is None:
        raise ContractError(f"policy {policy!r} found no threshold on the validation rows")
    details = {k: v for k, v in row.asDict().items() if k != "policy"}
    return ThresholdPolicy(policy, row["threshold"], artifact=artifact, details=details)


def evaluate_locked(test: DataFrame, policy: ThresholdPolicy, label: str = "label", score: str = "score") -> DataFrame:
    """Metrics at the locked threshold; nothing here depends on how the test rows would like to be cut."""
    return evaluate(test, policy.threshold, label, score).withColumn("policy", F.lit(policy.name))
