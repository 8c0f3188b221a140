"""Model families as Spark ML pipelines, and scored tables from them."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rarelens.operators.curves import average_precision
from rarelens.operators.splits import class_weight
from rarelens.plans.ensembles import HistogramTrees
from rarelens.plans.estimators import PopulationScaler, RobustColumnScaler
from rarelens.plans.fitonly import OverSampler, TrainingPipeline
from rarelens.plans.scoring import positive_score

LABEL, WEIGHT, VALIDATION = "label", "_weight", "_validation"


class AveragePrecisionEvaluator(Evaluator, DefaultParamsReadable, DefaultParamsWritable):
    """Step-sum average precision for Spark ML search (the built-in area under PR is a trapezoid)."""

    labelCol = Param(Params._dummy(), "labelCol", "label column", TypeConverters.toString)

    def __init__(self, labelCol: str = LABEL):
        super().__init__()
        self._setDefault(labelCol=LABEL)
        self._set(labelCol=labelCol)

    def _evaluate(self, dataset: DataFrame) -> float:
        label = self.getOrDefault(self.labelCol)
        scored = positive_score(dataset, "_score").select(F.col(label).alias("label"), F.col("_score").alias("score"))
        value = average_precision(scored).first()
        return float(value[0]) if value and value[0] is not None else 0.0

    def isLargerBetter(self) -> bool:
        return True


class RecallEvaluator(AveragePrecisionEvaluator):
    """Recall of the hard prediction."""

    def _evaluate(self, dataset: DataFrame) -> float:
        label = self.getOrDefault(self.labelCol)
        hit = F.count(F.when((F.col(label) == 1) & (F.col("prediction") == 1), 1))
        row = dataset.agg(hit.alias("tp"), F.count(F.when(F.col(label) == 1, 1)).alias("p")).first()
        return row["tp"] / row["p"] if row["p"] else 0.0


def logistic(C: float = 1.0, max_iter: int = 1000, total_weight: float | None = None, **params) -> LogisticRegression:
    """L2 logistic regression. `C` weighs the summed loss, Spark the mean loss: regParam = 1 / (C * total weight)."""
    reg = 1.0 / (C * total_weight) if total_weight else 0.0
    return LogisticRegression(regParam=reg, elasticNetParam=0.0, standardization=False, maxIter=max_iter,
                              featuresCol="features", labelCol=LABEL, **params)


def decision_tree(max_depth: int = 12, min_leaf: int = 1, criterion: str = "gini", seed: int = 42, **params):
    return DecisionTreeClassifier(maxDepth=max_depth, minInstancesPerNode=min_leaf, impurity=criterion, seed=seed,
                                  featuresCol="features", labelCol=LABEL, **params)


def random_forest(n_estimators: int = 300, max_depth: int = 12, min_leaf: int = 1, max_features: str = "sqrt",
                  bootstrap: bool = True, seed: int = 42, **params):
    return RandomForestClassifier(numTrees=n_estimators, maxDepth=max_depth, minInstancesPerNode=min_leaf,
                                  featureSubsetStrategy=max_features, bootstrap=bootstrap, seed=seed,
                                  featuresCol="features", labelCol=LABEL, **params)


def boosted_trees(n_estimators: int = 400, max_depth: int = 6, learning_rate: float = 0.05, subsample: float = 0.8,
                  colsample: float | str = "all", min_child: int = 1, gamma: float = 0.0, seed: int = 42, **params):
    """Gradient-boosted trees; `gamma` maps to the minimum split gain, L1/L2 leaf penalties have no counterpart."""
    return GBTClassifier(maxIter=n_estimators, maxDepth=max_depth, stepSize=learning_rate, subsamplingRate=subsample,
                         featureSubsetStrategy=str(colsample), minInstancesPerNode=min_child, minInfoGain=gamma,
                         seed=seed, featuresCol="features", labelCol=LABEL, **params)


def gradient_boosting(n_estimators: int = 400, max_depth: int = 6, learning_rate: float = 0.05, subsample: float = 0.8, colsample: float = 1.0,
                      min_child: float = 1.0, gamma: float = 0.0, reg_alpha: float = 0.0, reg_lambda: float = 1.0, max_delta_step: float = 0.0,
                      metric: str = "aucpr", seed: int = 42, **params) -> HistogramTrees:
    """Second-order boosting with leaf penalties; with validation rows it can stop after rounds without gain."""
    return HistogramTrees("boosted", label=LABEL, rounds=n_estimators, rate=learning_rate, max_depth=max_depth, subsample=subsample, colsample=colsample,
                          min_child=min_child, gamma=gamma, reg_alpha=reg_alpha, reg_lambda=reg_lambda, max_delta_step=max_delta_step, metric=metric,
                          seed=seed, **params)


def histogram_tree(max_depth: int | None = None, min_split: int = 2, min_leaf: int = 1, criterion: str = "gini", seed: int = 42, **params) -> HistogramTrees:
    """A tree with a least size of the nodes that may be split, and no limit of depth unless given."""
    return HistogramTrees("averaged", label=LABEL, max_depth=max_depth, min_split=min_split, min_leaf=min_leaf, criterion=criterion, seed=seed, **params)


def histogram_forest(n_estimators: int = 300, max_depth: int | None = None, min_split: int = 2, min_leaf: int = 1, max_features: float | int | str = "sqrt",
                     bootstrap: bool = True, class_weight: str | Sequence[float] | None = None, seed: int = 42, **params) -> HistogramTrees:
    """A forest grown together; `class_weight` "balanced_subsample" weighs classes within each tree's own draw."""
    weight = list(class_weight) if isinstance(class_weight, (list, tuple)) else class_weight
    return HistogramTrees("averaged", label=LABEL, trees=n_estimators, max_depth=max_depth, min_split=min_split, min_leaf=min_leaf, features=max_features,
                          bootstrap=bootstrap, class_weight=weight, seed=seed, **params)


FAMILIES: dict[str, Callable[..., Any]] = {
    "logreg": logistic, "decision_tree": decision_tree, "random_forest": random_forest, "boosted_trees": boosted_trees,
    "gradient_boosting": gradient_boosting, "histogram_tree": histogram_tree, "histogram_forest": histogram_forest}


@dataclass
class ModelSpec:
    """How to build one model: family, parameters, scaler and class weighting."""

    family: str | Callable[..., Any]
    params: Mapping[str, Any] = field(default_factory=dict)
    features: Sequence[str] = ()
    target: str = "Class"
    scaler: str | None = None  # None, "standard" or "robust"
    weights: str | float | Mapping = "none"
    #: Options of `OverSampler` (with `key`): minority rows are drawn between the scaled training rows, at fit only.
    resample: Mapping[str, Any] | None = None
    spark_params: Mapping[str, Any] = field(default_factory=dict)

    def training_table(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """features + label (double) + weight; weights come from the class counts of these rows."""
        return df.select(*self.features, *keep, F.col(self.target).cast("double").alias(LABEL),
                         class_weight(df, self.target, self.weights).cast("double").alias(WEIGHT))

    def classifier(self, total_weight: float | None = None):
        build = FAMILIES[self.family] if isinstance(self.family, str) else self.family
        extra = {"total_weight": total_weight} if build is logistic else {}
        model = build(**{**self.params, **extra})
        for name, value in self.spark_params.items():
            model.set(model.getParam(name), value)
        return model.setWeightCol(WEIGHT) if model.hasParam("weightCol") else model

    def steps(self) -> list:
        """What comes before the classifier: scaling, over-sampling at fit, assembling."""
        names = list(self.features)
        scaled = [f"{c}_scaled" for c in names] if self.scaler else names
        scalers = {None: [], "standard": [PopulationScaler(inputCols=names, outputCols=scaled)],
                   "robust": [RobustColumnScaler(inputCols=names, outputCols=scaled)]}
        assembler = VectorAssembler(inputCols=scaled, outputCol="features", handleInvalid="error")
        drawn = []
        if self.resample is not None:
            options = dict(self.resample)
            drawn = [OverSampler(scaled, LABEL, options.pop("key"), WEIGHT, self.weights, **options)]
        return [*scalers[self.scaler], *drawn, assembler]

    def pipeline(self, classifier) -> Pipeline:
        return TrainingPipeline(stages=[*self.steps(), classifier])

    def fit(self, train: DataFrame, validation: DataFrame | None = None, patience: float | int = 0.01) -> PipelineModel:
        """Fit on train only. With `validation`, boosted trees stop early on those rows.

        `patience` is the least gain of a round for "boosted_trees", a number of rounds without gain for "gradient_boosting".
        """
        if self.resample is not None:
            if validation is not None:
                raise ValueError("over-sampling and stopping by validation rows are not combined")
            fitted, rows = TrainingPipeline(stages=self.steps()).prepare(self.training_table(train, [self.resample["key"]]))
            rows = rows.select("features", LABEL, WEIGHT).persist()
            try:
                return PipelineModel([*fitted, self.classifier(self._total_weight(rows)).fit(rows)])
            finally:
                rows.unpersist()
        table = self.training_table(train)
        classifier = self.classifier(self._total_weight(table))
        if validation is not None and classifier.hasParam("validationIndicatorCol"):
            held = validation.select(*self.features, F.col(self.target).cast("double").alias(LABEL),
                                     F.lit(1.0).alias(WEIGHT), F.lit(True).alias(VALIDATION))
            table = table.withColumn(VALIDATION, F.lit(False)).unionByName(held)
            stop = {"patience": max(1, int(patience))} if isinstance(classifier, HistogramTrees) else {"validationTol": patience}
            classifier = classifier.setParams(validationIndicatorCol=VALIDATION, **stop)
        # A training table is read once per iteration; Spark recomputes lost cached blocks from the source.
        table = table.persist()
        try:
            return self.pipeline(classifier).fit(table)
        finally:
            table.unpersist()

    def _total_weight(self, table: DataFrame) -> float | None:
        if self.family not in ("logreg", logistic):
            return None
        return float(table.agg(F.sum(WEIGHT)).first()[0])


def score_model(model: PipelineModel, df: DataFrame, target: str = "Class", keep: Sequence[str] = ()) -> DataFrame:
    """The scored contract (keep, label, score) from a fitted pipeline."""
    return positive_score(model.transform(df)).select(*keep, F.col(target).cast("int").alias("label"), "score")


def expected_features(model: PipelineModel) -> list[str]:
    """Input columns a fitted pipeline needs, read from its first stage that names any."""
    for stage in model.stages:
        if stage.hasParam("inputCols"):
            return list(stage.getOrDefault("inputCols"))
    raise ValueError("the pipeline has no stage with input columns")


def importances(model: PipelineModel, spark) -> DataFrame:
    """(feature, importance) of trees or (feature, coefficient) of a linear model, strongest first."""
    names, last = expected_features(model), model.stages[-1]
    if hasattr(last, "coefficients"):
        rows = [(n, float(v)) for n, v in zip(names, last.coefficients.toArray())]
        out = spark.createDataFrame(rows, "feature string, coefficient double")
        return out.orderBy(F.desc(F.abs("coefficient")), "feature")
    rows = [(n, float(v)) for n, v in zip(names, last.featureImportances.toArray())]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def tree_rules(model: PipelineModel) -> str:
    """Readable rules of a shallow tree with feature names filled in."""
    text, names = model.stages[-1].toDebugString, expected_features(model)
    for i in reversed(range(len(names))):
        text = text.replace(f"feature {i} ", f"{names[i]} ").replace(f"feature {i})", f"{names[i]})")
    return text


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
