"""Boosted trees with second-order leaves, forests and single trees from histogram growth, as Spark ML estimators.

Boosting keeps the margin as a column of a written table. A round grows one tree, one scan per level, then one scan adds its
leaf steps to the margins of training and validation rows alike, so a round scores one tree only; the table of the round
before is deleted. With validation rows, boosting stops after `patience` rounds without a better metric and keeps the trees
up to the best round. Trees of a forest grow together. What the driver holds is trees.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from rarelens.operators.curves import average_precision
from rarelens.operators.trees import Growth, Tree, binned, grow, leaf_values, quantile_edges, rows_of_bytes
from rarelens.session import discard, materialize, ship_with_tasks

ship_with_tasks(__name__)

METRICS = {"aucpr": True, "logloss": False, "error": False}     # is larger better


@dataclass
class Forest:
    """Trees with how their leaves combine: summed steps behind a logistic curve, or averaged class shares."""

    trees: list[Tree] = field(default_factory=list)
    kind: str = "boosted"                 # or "averaged"
    rate: float = 1.0
    base_margin: float = 0.0
    history: list[float] = field(default_factory=list)      # validation metric of every round

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Margin (boosted) or share of class 1 (averaged) of rows by features; NaN is missing."""
        out = np.zeros(len(x))
        for t in self.trees:
            out += np.array(t.value)[t.leaf_of(x)]
        return self.base_margin + self.rate * out if self.kind == "boosted" else out / max(len(self.trees), 1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        raw = self.raw(x)
        return 1 / (1 + np.exp(-raw)) if self.kind == "boosted" else raw

    def importances(self, width: int) -> np.ndarray:
        """Summed gains per feature, normalised."""
        total = np.zeros(width)
        for t in self.trees:
            for f, g in zip(t.feature, t.gain, strict=True):
                if f >= 0:
                    total[f] += g
        return total / total.sum() if total.sum() > 0 else total

    def rules(self, names: Sequence[str] | None = None) -> str:
        lines = []

        def walk(t: Tree, node: int, indent: str) -> None:
            if t.left[node] < 0:
                lines.append(f"{indent}Predict: {t.value[node]!r}")
                return
            name = names[t.feature[node]] if names else f"feature {t.feature[node]}"
            lines.append(f"{indent}If ({name} < {t.threshold[node]!r})")
            walk(t, t.left[node], indent + " ")
            lines.append(f"{indent}Else ({name} >= {t.threshold[node]!r})")
            walk(t, t.right[node], indent + " ")
        for i, t in enumerate(self.trees):
            lines.append(f"Tree {i}:")
            walk(t, 0, " ")
        return "\n".join(lines)

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> Forest:
        found = json.loads(text)
        return Forest(**{**found, "trees": [Tree(**t) for t in found["trees"]]})


def node_table(forest: Forest, spark) -> DataFrame:
    """One line per node, `path` being the turns from the root (L and R)."""
    names = ("depth", "feature", "threshold", "missing_left", "left", "right", "value", "cover", "gain", "rows")
    lines = []
    for i, t in enumerate(forest.trees):
        paths = {0: ""}
        for n in range(len(t.left)):         # parents come before their children
            if t.left[n] >= 0:
                paths[t.left[n]], paths[t.right[n]] = paths[n] + "L", paths[n] + "R"
            lines.append((i, n, paths[n], *[getattr(t, c)[n] for c in names]))
    kinds = "tree int, node int, path string, depth int, feature int, threshold double, missing_left boolean, left int, right int, value double, cover double, gain double, rows long"
    return spark.createDataFrame(lines, kinds)


# Boosting ------------------------------------------------------------------------------------------------------


def _stepped(table: DataFrame, tree: Tree, rate: float, width: int) -> DataFrame:
    """The written table with the tree's steps added to its margins."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("margin")
            step = leaf_values([tree], rows_of_bytes(batch.column("bins"), width))[:, 0]
            yield batch.set_column(at, "margin", pa.array(batch.column("margin").to_numpy() + rate * step))

    return materialize(table.mapInArrow(run, table.schema), "margins")


def _metric(held: DataFrame, name: str) -> float:
    """Of the validation rows' margins. Average precision orders by margin, which needs no probability."""
    if name == "aucpr":
        value = average_precision(held.select(F.col("label").cast("int").alias("label"), F.col("margin").alias("score"))).first()
        return float(value[0]) if value and value[0] is not None else 0.0
    m = F.col("margin")
    # -log of the probability of the row's class, without overflow
    loss = F.log1p(F.exp(-F.abs(m))) + F.greatest(F.when(F.col("label") == 1, -m).otherwise(m), F.lit(0.0))
    wrong = ((m > 0) != (F.col("label") == 1)).cast("double")
    value = held.agg(F.sum(F.col("weight") * (loss if name == "logloss" else wrong)) / F.sum("weight")).first()[0]
    return float(value) if value is not None else math.inf


def boost(train: DataFrame, features: Sequence[str], label: str, weight: str | None = None, validation: str | None = None, rounds: int = 100,
          rate: float = 0.3, growth: Growth | None = None, patience: int | None = None, metric: str = "aucpr", base_score: float = 0.5,
          bins: int = 64, key: str | None = None, edges: Sequence[Sequence[float]] | None = None) -> Forest:
    """Gradient-boosted trees. Rows where the boolean column `validation` holds are scored, not learned from."""
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}")
    if patience is not None and validation is None:
        raise ValueError("patience needs validation rows")
    growth = growth or Growth(min_child=1.0)
    learned = train.where(f"not coalesce({validation}, false)") if validation else train
    edges = edges if edges is not None else quantile_edges(learned, features, bins)
    table = binned(train, features, edges, label, weight, key, keep={"held": validation} if validation else None)
    forest = Forest(kind="boosted", rate=rate, base_margin=math.log(base_score / (1 - base_score)))
    table = table.withColumn("margin", F.lit(forest.base_margin))
    counted = None if isinstance(growth.class_weight, str) else float(table.agg(F.sum("weight")).first()[0] or 0.0)
    best, better = None, (lambda a, b: a > b) if METRICS[metric] else (lambda a, b: a < b)
    for r in range(rounds):
        # every tree draws its own rows and features
        (tree,) = grow(table.where("not coalesce(held, false)") if validation else table, [replace(growth, seed=growth.seed + 1000 * r)], edges, counted)
        forest.trees.append(tree)
        last = r == rounds - 1
        if last and not validation:
            break
        stepped = _stepped(table, tree, rate, len(features))
        discard(table)
        table = stepped
        if not validation:
            continue
        forest.history.append(_metric(table.where("held"), metric))
        if best is None or better(forest.history[r], forest.history[best]):
            best = r
        if patience is not None and r - best >= patience:
            break
    discard(table)
    if patience is not None and best is not None:
        forest.trees = forest.trees[:best + 1]
    return forest


def average(train: DataFrame, features: Sequence[str], label: str, weight: str | None = None, growths: Sequence[Growth] = (), bins: int = 64,
            key: str | None = None, edges: Sequence[Sequence[float]] | None = None) -> Forest:
    """Trees of class shares, grown together: a single tree or a forest."""
    edges = edges if edges is not None else quantile_edges(train, features, bins)
    table = binned(train, features, edges, label, weight, key)
    trees = grow(table, growths, edges)
    discard(table)
    return Forest(trees, "averaged")


# Spark ML ------------------------------------------------------------------------------------------------------


def _scored(df: DataFrame, forest: Forest, vector: str) -> DataFrame:
    @pandas_udf("double")
    def raw(rows: pd.Series) -> pd.Series:
        return pd.Series(forest.raw(np.stack(rows.to_numpy())) if len(rows) else np.zeros(0))

    out = df.withColumn("_raw", raw(vector_to_array(vector)))
    p = 1 / (1 + F.exp(-F.col("_raw"))) if forest.kind == "boosted" else F.col("_raw")
    pair = F.array(-F.col("_raw"), F.col("_raw")) if forest.kind == "boosted" else F.array(1 - F.col("_raw"), F.col("_raw"))
    return (out.withColumn("rawPrediction", array_to_vector(pair)).withColumn("probability", array_to_vector(F.array(1 - p, p)))
            .withColumn("prediction", (p > 0.5).cast("double")).drop("_raw"))


class HistogramTreesModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Scores like any Spark classifier: rawPrediction, probability, prediction."""

    featuresCol = Param(Params._dummy(), "featuresCol", "vector column", TypeConverters.toString)
    forestJson = Param(Params._dummy(), "forestJson", "the trees", TypeConverters.toString)
    width = Param(Params._dummy(), "width", "number of features", TypeConverters.toInt)

    def __init__(self, forest: Forest | None = None, features: str = "features", width: int = 0):
        super().__init__()
        self._set(featuresCol=features, width=width, forestJson=(forest or Forest()).to_json())

    @property
    def forest(self) -> Forest:
        return Forest.from_json(self.getOrDefault("forestJson"))

    @property
    def featureImportances(self) -> DenseVector:  # noqa: N802 (name of Spark's tree models)
        return DenseVector(self.forest.importances(self.getOrDefault("width")))

    @property
    def getNumTrees(self) -> int:  # noqa: N802
        return len(self.forest.trees)

    @property
    def toDebugString(self) -> str:  # noqa: N802
        return self.forest.rules()

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return _scored(dataset, self.forest, self.getOrDefault("featuresCol"))


class HistogramTrees(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Boosted trees, a forest or a tree over a vector column; `how` is the JSON of the options of `boost` and `Growth`."""

    kind = Param(Params._dummy(), "kind", "boosted or averaged", TypeConverters.toString)
    how = Param(Params._dummy(), "how", "options as JSON", TypeConverters.toString)
    featuresCol = Param(Params._dummy(), "featuresCol", "vector column", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "0/1 column", TypeConverters.toString)
    weightCol = Param(Params._dummy(), "weightCol", "weights, if any", TypeConverters.toString)
    keyCol = Param(Params._dummy(), "keyCol", "what draws depend on, if any", TypeConverters.toString)
    validationIndicatorCol = Param(Params._dummy(), "validationIndicatorCol", "rows to stop by, if any", TypeConverters.toString)

    def __init__(self, kind: str = "boosted", vector: str = "features", label: str = "label", **how):
        super().__init__()
        self._set(kind=kind, featuresCol=vector, labelCol=label, how=json.dumps(how))

    def setWeightCol(self, name: str) -> HistogramTrees:  # noqa: N802
        return self._set(weightCol=name)

    def setParams(self, **params) -> HistogramTrees:  # noqa: N802
        patience = params.pop("patience", None)
        if patience is not None:
            params["how"] = json.dumps({**json.loads(self.getOrDefault("how")), "patience": patience})
        return self._set(**params)

    def _optional(self, name: str) -> str | None:
        return self.getOrDefault(name) if self.isSet(name) else None

    def _fit(self, dataset: DataFrame) -> HistogramTreesModel:
        how = json.loads(self.getOrDefault("how"))
        vector = self.getOrDefault("featuresCol")
        width = len(dataset.select(vector).first()[0])
        names = [f"_f{i}" for i in range(width)]
        flat = dataset.select("*", vector_to_array(vector).alias("_v")).select("*", *[F.col("_v")[i].alias(n) for i, n in enumerate(names)])
        weight, key, held = (self._optional(c) for c in ("weightCol", "keyCol", "validationIndicatorCol"))
        own = {k: how.pop(k) for k in list(how) if k in Growth.__dataclass_fields__}
        own["class_weight"] = tuple(own["class_weight"]) if isinstance(own.get("class_weight"), list) else own.get("class_weight")
        common = {"label": self.getOrDefault("labelCol"), "weight": weight, "key": key, "bins": how.pop("bins", 64)}
        if self.getOrDefault("kind") == "boosted":
            forest = boost(flat, names, growth=Growth(**own), validation=held, **common, **how)
        else:
            n, growth = how.pop("trees", 1), Growth(**{"criterion": "gini", **own})
            forest = average(flat, names, growths=[replace(growth, seed=growth.seed + 1000 * i) for i in range(n)], **common)
        return HistogramTreesModel(forest, vector, width)
