"""Report and experiment-log sinks."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from typing import Any

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rarelens.sources.tables import path_status


def plain(value: Any) -> Any:
    """Numpy scalars and arrays, at any depth, as plain Python values."""
    if isinstance(value, Mapping):
        return {str(k): plain(v) for k, v in value.items()}
    if isinstance(value, np.ndarray):
        return [plain(v) for v in value.tolist()]
    if isinstance(value, (list, tuple, set)):
        return [plain(v) for v in value]
    return value.item() if isinstance(value, np.generic) else value


def params_json(params: Mapping[str, Any]) -> str:
    return json.dumps(plain(params), sort_keys=True)


def write_report(df: DataFrame, path: str) -> None:
    """Report rows (structs, maps and arrays welcome) as JSON lines."""
    df.write.mode("overwrite").json(path)


def report_column(df: DataFrame, name: str = "report") -> DataFrame:
    """Each row folded into one JSON string column."""
    return df.select(F.to_json(F.struct(*df.columns)).alias(name))


def result_rows(spark: SparkSession, model: str, stage: str, params: Mapping[str, Any], metrics: DataFrame,
                runtime_s: float) -> DataFrame:
    """Metric rows labelled as one experiment-log entry."""
    return metrics.select(F.lit(model).alias("model"), F.lit(stage).alias("stage"),
                          F.lit(float(runtime_s)).alias("runtime_s"), F.lit(params_json(params)).alias("params_json"),
                          *metrics.columns)


def append_results(rows: DataFrame, path: str) -> None:
    """Append to the log; entries may differ in their metric columns."""
    rows.write.mode("append").parquet(path)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    if path_status(spark, path) is None:
        raise FileNotFoundError(path)
    return spark.read.option("mergeSchema", True).parquet(path)


def stack_results(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def best_by_family(results: DataFrame, family: str = "model", metric: str = "mean_test_score") -> DataFrame:
    return results.groupBy(family).agg(F.max(metric).alias(f"best_{metric}"))
