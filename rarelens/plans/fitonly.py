"""Steps that belong to fitting alone: rows that change at fit and pass through at transform, and fold-safe estimators.

Spark ML's `Pipeline` hands a later stage what an earlier stage's model makes of the rows, so a stage cannot change the training
rows without changing the scored ones. In a `TrainingPipeline` a stage with a `resample` method does: the stages behind it
are fitted on the rows it returns, and the fitted pipeline leaves it out. Scaling, over-sampling and fitting in this order
then work inside each training fold of `CrossValidator`.

`SpecEstimator` fits a whole `ModelSpec`, so class weights, the meaning of `C` and drawn rows come from the rows it is given: a
training fold learns nothing from the rows it is tested on. Its candidates name parameters of the spec or of the classifier.
"""

from __future__ import annotations

import inspect
import json
from collections.abc import Mapping
from dataclasses import replace
from typing import Any

from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rarelens.operators.resample import smote
from rarelens.operators.splits import class_weight


class OverSampler(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Synthetic minority rows at fit; its model changes nothing.

    `options` is the JSON of the options of `smote`. Columns other than the inputs and the label are NULL in synthetic rows.
    With `weightCol`, the class weights of `weights` are set anew from the resampled rows.
    """

    inputCols = Param(Params._dummy(), "inputCols", "features to draw between", TypeConverters.toListString)
    labelCol = Param(Params._dummy(), "labelCol", "0/1 column", TypeConverters.toString)
    keyCol = Param(Params._dummy(), "keyCol", "integer key that draws depend on", TypeConverters.toString)
    options = Param(Params._dummy(), "options", "options of smote", TypeConverters.toString)
    weightCol = Param(Params._dummy(), "weightCol", "weights to set, if any", TypeConverters.toString)
    weights = Param(Params._dummy(), "weights", "class weights as JSON", TypeConverters.toString)

    def __init__(self, inputCols=(), labelCol="label", keyCol="row_id", weightCol=None, weights="none", **options):  # noqa: N803
        super().__init__()
        self._set(inputCols=list(inputCols), labelCol=labelCol, keyCol=keyCol, options=json.dumps(options), weights=json.dumps(weights))
        if weightCol:
            self._set(weightCol=weightCol)

    def resample(self, df: DataFrame) -> DataFrame:
        """The given rows and the synthetic ones."""
        label, inputs = self.getOrDefault("labelCol"), self.getOrDefault("inputCols")
        made = smote(df, inputs, label, self.getOrDefault("keyCol"), **json.loads(self.getOrDefault("options")))
        kinds = {f.name: f.dataType for f in df.schema.fields}
        known = {*inputs, label}
        made = made.select(*[F.col(c).cast(kinds[c]).alias(c) if c in known else F.lit(None).cast(kinds[c]).alias(c) for c in df.columns])
        rows = df.unionByName(made)
        if self.isSet("weightCol"):
            mode = json.loads(self.getOrDefault("weights"))
            mode = {float(k): v for k, v in mode.items()} if isinstance(mode, dict) else mode
            rows = rows.withColumn(self.getOrDefault("weightCol"), class_weight(rows, label, mode).cast("double"))
        return rows

    def _fit(self, dataset: DataFrame) -> PassThrough:
        return PassThrough()


class PassThrough(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Rows as they are."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset


class TrainingPipeline(Pipeline):
    """A pipeline whose resampling stages act on training rows only."""

    def prepare(self, dataset: DataFrame) -> tuple[list[Transformer], DataFrame]:
        """(fitted stages without the resampling ones, the training rows behind the last stage)."""
        fitted = []
        for stage in self.getStages():
            if hasattr(stage, "resample"):
                dataset = stage.resample(dataset)
                continue
            model = stage if isinstance(stage, Transformer) else stage.fit(dataset)
            fitted.append(model)
            dataset = model.transform(dataset)
        return fitted, dataset

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        *before, last = self.getStages()
        if isinstance(last, Transformer) or hasattr(last, "resample"):
            return PipelineModel(self.prepare(dataset)[0])
        fitted, rows = TrainingPipeline(stages=before).prepare(dataset)
        return PipelineModel([*fitted, last.fit(rows)])


class SpecEstimator(Estimator):
    """Fits a model spec; `candidate` is the JSON of parameters that replace the spec's."""

    candidate = Param(Params._dummy(), "candidate", "parameters as JSON", TypeConverters.toString)

    def __init__(self, spec: Any = None):
        super().__init__()
        self.spec = spec
        self._setDefault(candidate="{}")

    def maps(self, candidates: list[Mapping[str, Any]]) -> list[dict]:
        return [{self.candidate: json.dumps(dict(c))} for c in candidates]

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        from rarelens.plans.models import FAMILIES
        params = json.loads(self.getOrDefault(self.candidate))
        build = FAMILIES[self.spec.family] if isinstance(self.spec.family, str) else self.spec.family
        own = {k: v for k, v in params.items() if k in inspect.signature(build).parameters}
        rest = {k: v for k, v in params.items() if k not in own}
        return replace(self.spec, params={**self.spec.params, **own}, spark_params={**self.spec.spark_params, **rest}).fit(dataset)
