"""Fit/transform feature stages for Spark ML pipelines.

Fitting is one aggregation whose few numbers become model parameters; transforming is a projection of column
expressions with those numbers as literals (no Python per row), so stages work on batches and streams alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasOutputCol, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rarelens.functions import features as fx
from rarelens.operators.ordered import quantiles
from rarelens.operators.profile import sample_skewness

# Fixed values
AMOUNT_QUANTILES = (0.50, 0.90, 0.95, 0.99)
LOG_SKEW_LIMIT = 1.0


def engineer(df: DataFrame, time: str = "Time", amount: str = "Amount", negatives: str = "clip") -> DataFrame:
    """Hour, hour_sin, hour_cos and Amount_log1p (kept if present) in a single projection."""
    new = {}
    if time in df.columns:
        hour = fx.hour_of_day(time)
        new |= {"Hour": hour, "hour_sin": fx.hour_sin(hour), "hour_cos": fx.hour_cos(hour)}
    if amount in df.columns and "Amount_log1p" not in df.columns:
        new["Amount_log1p"] = fx.log_amount(amount, negatives)
    return df.withColumns(new)


class _TextParams(Params):
    """Small helper: declare and read parameters by name."""

    def _get(self, name: str):
        return self.getOrDefault(self.getParam(name))


class ServingFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """The four serving features as a pipeline stage."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return engineer(df)


class TimeFeatures(Transformer, _TextParams, DefaultParamsReadable, DefaultParamsWritable):
    """Hour, cyclical encoding and night flag from seconds."""

    timeCol = Param(Params._dummy(), "timeCol", "seconds column", TypeConverters.toString)
    hour = Param(Params._dummy(), "hour", "hour output", TypeConverters.toString)
    sin = Param(Params._dummy(), "sin", "sine output", TypeConverters.toString)
    cos = Param(Params._dummy(), "cos", "cosine output", TypeConverters.toString)
    night = Param(Params._dummy(), "night", "night flag output", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, timeCol="Time", hour="hour", sin="sin_hour", cos="cos_hour", night="night_flag"):
        super().__init__()
        self._setDefault(timeCol="Time", hour="hour", sin="sin_hour", cos="cos_hour", night="night_flag")
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        h = fx.hour_of_day(self._get("timeCol"))
        return df.withColumns({self._get("hour"): h, self._get("sin"): fx.hour_sin(h),
                               self._get("cos"): fx.hour_cos(h), self._get("night"): fx.night_flag(h)})


class _AmountParams(_TextParams):
    amountCol = Param(Params._dummy(), "amountCol", "amount column", TypeConverters.toString)
    scaled = Param(Params._dummy(), "scaled", "also emit amount_scaled", TypeConverters.toBoolean)
    limits = Param(Params._dummy(), "limits", "train quantiles 50/90/95/99", TypeConverters.toListFloat)
    moments = Param(Params._dummy(), "moments", "train mean and population std", TypeConverters.toListFloat)


class AmountFeatures(Estimator, _AmountParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns amount quantiles and moments on the training rows only."""

    @keyword_only
    def __init__(self, *, amountCol="Amount", scaled=True):
        super().__init__()
        self._setDefault(amountCol="Amount", scaled=True)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "AmountFeaturesModel":
        c = self._get("amountCol")
        found = {r["prob"]: r["value"] for r in quantiles(df, [c], AMOUNT_QUANTILES).collect()}
        mean, std = df.agg(F.avg(c), F.stddev_pop(c)).first()
        model = AmountFeaturesModel()
        return model._set(amountCol=c, scaled=self._get("scaled"), limits=[found[p] for p in AMOUNT_QUANTILES],
                          moments=[mean, std])


class AmountFeaturesModel(Model, _AmountParams, DefaultParamsReadable, DefaultParamsWritable):
    """log_amount, amount_gt_90/95/99 (strictly above), amount_bin 0..3 (at or above) and amount_scaled."""

    def _transform(self, df: DataFrame) -> DataFrame:
        c = self._get("amountCol")
        q50, q90, q95, q99 = self._get("limits")
        new = {"log_amount": fx.log_amount(c, "raw"), "amount_gt_90": fx.above(c, q90),
               "amount_gt_95": fx.above(c, q95), "amount_gt_99": fx.above(c, q99),
               "amount_bin": fx.bin_index(c, [q50, q90, q99])}
        if self._get("scaled"):
            mean, std = self._get("moments")
            new["amount_scaled"] = fx.z_score(c, mean, std)
        return df.withColumns(new)


class _ScalerParams(HasInputCols, HasOutputCols, _TextParams):
    centers = Param(Params._dummy(), "centers", "per-column centre", TypeConverters.toListFloat)
    scales = Param(Params._dummy(), "scales", "per-column scale", TypeConverters.toListFloat)


class PopulationScaler(Estimator, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Standardise with the population deviation (Spark ML's own scaler uses the sample deviation)."""

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] = (), outputCols: Sequence[str] | None = None):
        super().__init__()
        self._set(inputCols=list(inputCols), outputCols=list(outputCols or inputCols))

    def _fit(self, df: DataFrame) -> "ColumnScalerModel":
        cols = self.getInputCols()
        row = df.agg(*[F.avg(c) for c in cols], *[F.stddev_pop(c) for c in cols]).first()
        return ColumnScalerModel()._set(inputCols=cols, outputCols=self.getOutputCols(),
                                        centers=[float(v) for v in row[:len(cols)]],
                                        scales=[float(v) for v in row[len(cols):]])


class RobustColumnScaler(Estimator, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Centre on the exact median and scale by the exact interquartile range."""

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] = (), outputCols: Sequence[str] | None = None):
        super().__init__()
        self._set(inputCols=list(inputCols), outputCols=list(outputCols or inputCols))

    def _fit(self, df: DataFrame) -> "ColumnScalerModel":
        cols = self.getInputCols()
        q = {(r["column"], r["prob"]): r["value"] for r in quantiles(df, cols, [0.25, 0.5, 0.75]).collect()}
        return ColumnScalerModel()._set(inputCols=cols, outputCols=self.getOutputCols(),
                                        centers=[q[c, 0.5] for c in cols],
                                        scales=[q[c, 0.75] - q[c, 0.25] for c in cols])


class ColumnScalerModel(Model, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    def _transform(self, df: DataFrame) -> DataFrame:
        parts = zip(self.getInputCols(), self.getOutputCols(), self._get("centers"), self._get("scales"))
        return df.withColumns({out: fx.z_score(c, m, s) for c, out, m, s in parts})


class _AutoParams(HasInputCol, HasOutputCol, _TextParams):
    choice = Param(Params._dummy(), "choice", "auto, zscore or logz", TypeConverters.toString)
    center = Param(Params._dummy(), "center", "mean", TypeConverters.toFloat)
    scale = Param(Params._dummy(), "scale", "population std", TypeConverters.toFloat)


class AutoScaler(Estimator, _AutoParams, DefaultParamsReadable, DefaultParamsWritable):
    """z-score, taken of log1p when the bias-corrected skewness exceeds one (choice "auto")."""

    @keyword_only
    def __init__(self, *, inputCol="Amount", outputCol="Amount_scaled", choice="auto"):
        super().__init__()
        self._setDefault(inputCol="Amount", outputCol="Amount_scaled", choice="auto")
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "AutoScalerModel":
        c = self.getInputCol()
        log = F.log1p(F.when(F.col(c) > -1, F.col(c)))
        skew, m, s, log_m, log_s = df.agg(sample_skewness(c), F.avg(c), F.stddev_pop(c), F.avg(log),
                                          F.stddev_pop(log)).first()
        method = self._get("choice")
        if method == "auto":
            method = "logz" if skew is not None and skew > LOG_SKEW_LIMIT else "zscore"
        center, scale = (log_m, log_s) if method == "logz" else (m, s)
        return AutoScalerModel()._set(inputCol=c, outputCol=self.getOutputCol(), choice=method, center=center, scale=scale)


class AutoScalerModel(Model, _AutoParams, DefaultParamsReadable, DefaultParamsWritable):
    @property
    def method(self) -> str:
        return self._get("choice")

    def _transform(self, df: DataFrame) -> DataFrame:
        c = F.col(self.getInputCol())
        value = F.log1p(c) if self.method == "logz" else c
        return df.withColumn(self.getOutputCol(), fx.z_score(value, self._get("center"), self._get("scale")))
