"""Frozen contracts: raw and model schemas, threshold policy, model metadata.

These are config-sized records checked on the driver before a job starts; row-level rules are columns
(see `plans.scoring`).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values
TARGET_CANDIDATES = ("Class", "class", "is_fraud", "fraud")
PCA_FEATURES = tuple(f"V{i}" for i in range(1, 29))
RAW_FEATURES = ("Time", *PCA_FEATURES, "Amount")
ENGINEERED_FEATURES = ("Hour", "hour_sin", "hour_cos", "Amount_log1p")
TARGET = "Class"

RAW_SCHEMA = T.StructType(
    [T.StructField(c, T.DoubleType()) for c in RAW_FEATURES] + [T.StructField(TARGET, T.IntegerType())])


class ContractError(ValueError):
    """A schema, policy or table breaks its contract."""


def find_target(df: DataFrame, candidates: Sequence[str] = TARGET_CANDIDATES) -> str:
    """First candidate present, matched case-sensitively."""
    for name in candidates:
        if name in df.columns:
            return name
    raise ContractError(f"no target column; looked for {list(candidates)} in {df.columns}")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def select_numeric(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Numeric columns only (plus `keep`), original order."""
    numeric = set(numeric_columns(df))
    return df.select(*[c for c in df.columns if c in numeric or c in keep])


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ContractError(f"missing required columns: {missing}")
    return df


def repeated(names: Sequence[str]) -> list[str]:
    """Names that occur more than once, ordered by where the first repetition shows."""
    seen: set[str] = set()
    again: dict[str, None] = {}
    for name in names:
        if name in seen:
            again[name] = None
        seen.add(name)
    return list(again)


@dataclass(frozen=True)
class FeatureContract:
    """Raw inputs, engineered additions and the exact model order."""

    raw: tuple[str, ...] = RAW_FEATURES
    engineered: tuple[str, ...] = ENGINEERED_FEATURES
    target: str = TARGET
    version: str = "unversioned"

    @property
    def model(self) -> tuple[str, ...]:
        return self.raw + self.engineered

    @classmethod
    def from_config(cls, config: Any) -> "FeatureContract":
        """Validate a config record with raw_input_features, engineered_features and model_features."""
        if not isinstance(config, Mapping):
            raise ContractError("the feature schema must be a mapping")
        keys = ("raw_input_features", "engineered_features", "model_features")
        absent = [k for k in keys if k not in config]
        if absent:
            raise ContractError(f"feature schema lacks keys: {absent}")
        for key in keys:
            names = config[key]
            if not isinstance(names, list) or any(not isinstance(n, str) for n in names):
                raise ContractError(f"{key} must be a list of strings")
            if again := repeated(names):
                raise ContractError(f"duplicate feature names in {key}: {again}")
        raw, engineered, model = (tuple(config[k]) for k in keys)
        if model != raw + engineered:
            raise ContractError("model_features must be raw_input_features followed by engineered_features, in order")
        return cls(raw, engineered, config.get("target_column", TARGET), str(config.get("schema_version", "unversioned")))


@dataclass(frozen=True)
class ThresholdPolicy:
    """A locked decision threshold. Evaluation takes one of these and has no means of choosing another."""

    name: str
    threshold: float
    version: str = "1"
    artifact: str = "model"
    selected_on: str = "validation"
    details: Mapping[str, Any] = field(default_factory=dict, compare=False)

    def __post_init__(self):
        if isinstance(self.threshold, bool) or not isinstance(self.threshold, (int, float)):
            raise ContractError("threshold must be numeric")
        if not 0.0 <= float(self.threshold) <= 1.0:
            raise ContractError("threshold must lie in [0, 1]")
        if not isinstance(self.artifact, str) or not self.artifact.strip():
            raise ContractError("the model artifact reference must be a non-empty string")

    @classmethod
    def from_config(cls, config: Mapping[str, Any]) -> "ThresholdPolicy":
        needed = ("policy_name", "policy_version", "threshold", "reference_model_artifact")
        absent = [k for k in needed if k not in config]
        if absent:
            raise ContractError(f"threshold config lacks keys: {absent}")
        return cls(config["policy_name"], config["threshold"], config["policy_version"],
                   config["reference_model_artifact"], config.get("selected_on", "validation"), dict(config))


@dataclass(frozen=True)
class Alignment:
    dropped: list[str]
    missing_filled: list[str]
    expected_count: int


def align_strict(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Exact model order as doubles; extra columns are ignored, a missing one is an error."""
    missing = [c for c in features if c not in df.columns]
    if missing:
        raise ContractError(f"missing features after preprocessing: {missing}")
    return df.select(*keep, *[F.col(c).cast("double").alias(c) for c in features])


def align_lenient(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> tuple[DataFrame, Alignment]:
    """Training order with absent features as 0.0, and a record of what changed."""
    have = set(df.columns)
    out = df.select(*keep, *[F.col(c) if c in have else F.lit(0.0).alias(c) for c in features])
    info = Alignment([c for c in df.columns if c not in features and c not in keep],
                     [c for c in features if c not in have], len(features))
    return out, info


def column_differences(df: DataFrame, expected: Sequence[str]) -> tuple[list[str], list[str]]:
    """(missing in contract order, unexpected sorted)."""
    return [c for c in expected if c not in df.columns], sorted(set(df.columns) - set(expected))
