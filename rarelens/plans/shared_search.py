"""Searches over trees and forests in shared scans: all candidates and all folds grow together.

The table is binned and written once with its fold. Every tree of every candidate and every fold is one more tree of the same
growth: a level of all of them is one scan (more if the open nodes' sums exceed the memory of a task), however many
candidates there are. One further scan scores each row by the trees that did not learn from its fold; precision and recall come
from one curve over (candidate, fold). The driver holds trees and one line per candidate and fold.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rarelens.operators.curves import average_precision
from rarelens.operators.splits import k_folds
from rarelens.operators.trees import Growth, Tree, binned, grow, leaf_values, quantile_edges, rows_of_bytes
from rarelens.session import discard, ship_with_tasks
from rarelens.sources.reports import params_json

ship_with_tasks(__name__)

METRICS = ("aucpr", "recall")


@dataclass
class SharedResult:
    """`table` is (candidate, params_json, mean_test_score, std_test_score, rank), `folds` (candidate, fold, score)."""

    table: DataFrame
    folds: DataFrame
    best_params: dict[str, Any]
    best_score: float


def _growth(params: Mapping[str, Any], seed: int, fold: int, tree: int) -> Growth:
    own = {k: tuple(v) if isinstance(v, list) else v for k, v in params.items() if k != "trees"}
    return Growth(**{"criterion": "gini", "max_depth": None, **own, "skip_fold": fold, "seed": seed + 1000 * tree})


def shared_search(df: DataFrame, features: Sequence[str], target: str, keys: Sequence[str], candidates: Sequence[Mapping[str, Any]], folds: int = 3,
                  metric: str = "aucpr", bins: int = 64, seed: int = 42, fold_col: str | None = None) -> SharedResult:
    """Cross-validated scores of candidates, each naming fields of `Growth` and a number of `trees` (one by default).

    Folds are stratified by digests of `keys` unless `fold_col` (0 to folds - 1) gives them. "recall" is that of shares over 0.5.
    A fold without positives counts as 0.
    """
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}")
    if not candidates:
        raise ValueError("no candidates")
    folded = df.withColumn("_fold", F.col(fold_col).cast("int")) if fold_col else k_folds(df, target, keys, folds, "_fold", seed)
    edges = quantile_edges(folded, features, bins)
    table = binned(folded.withColumn("_key", F.xxhash64(*keys)), features, edges, target, key="_key", keep={"fold": "_fold"})
    plan = [(c, f, t) for c, p in enumerate(candidates) for f in range(folds) for t in range(int(p.get("trees", 1)))]
    grown = grow(table, [_growth(candidates[c], seed, f, t) for c, f, t in plan], edges)
    by_fold: dict[int, dict[int, list[Tree]]] = {f: {} for f in range(folds)}
    for (c, f, _), tree in zip(plan, grown, strict=True):
        by_fold[f].setdefault(c, []).append(tree)
    width = len(features)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, fold = rows_of_bytes(batch.column("bins"), width), batch.column("fold").to_numpy()
            out = np.zeros((len(codes), len(candidates)))
            for f, each in by_fold.items():
                own = np.flatnonzero(fold == f)
                for c, trees in each.items():
                    out[own, c] = leaf_values(trees, codes[own]).mean(1)
            at = pa.array(np.arange(len(codes) + 1, dtype=np.int32) * len(candidates))
            yield pa.RecordBatch.from_arrays([batch.column("fold"), batch.column("label"), pa.ListArray.from_arrays(at, pa.array(out.ravel()))],
                                             names=["fold", "label", "scores"])

    scored = table.select("fold", "label", "bins").mapInArrow(score, "fold int, label double, scores array<double>").select(
        "fold", F.col("label").cast("int").alias("label"), F.posexplode("scores").alias("candidate", "score"))
    if metric == "aucpr":
        found = average_precision(scored, by=["candidate", "fold"]).withColumnRenamed("average_precision", "value")
    else:
        hits = F.count(F.when((F.col("label") == 1) & (F.col("score") > 0.5), 1))
        found = scored.groupBy("candidate", "fold").agg(F.try_divide(hits, F.count(F.when(F.col("label") == 1, 1))).alias("value"))
    values = {(r["candidate"], r["fold"]): float(r["value"] or 0.0) for r in found.select("candidate", "fold", "value").collect()}
    discard(table)
    lines = [(c, f, values.get((c, f), 0.0)) for c in range(len(candidates)) for f in range(folds)]
    scores = [[values.get((c, f), 0.0) for f in range(folds)] for c in range(len(candidates))]
    means = [float(np.mean(s)) for s in scores]
    ranks = [1 + sum(other > m for other in means) for m in means]
    best = min(range(len(candidates)), key=lambda c: (ranks[c], c))
    spark = df.sparkSession
    rows = [(c, params_json(dict(p)), means[c], float(np.std(scores[c])), ranks[c]) for c, p in enumerate(candidates)]
    out = spark.createDataFrame(rows, "candidate int, params_json string, mean_test_score double, std_test_score double, rank int")
    return SharedResult(out.orderBy("rank", "candidate"), spark.createDataFrame(lines, "candidate int, fold int, score double"), dict(candidates[best]), means[best])
