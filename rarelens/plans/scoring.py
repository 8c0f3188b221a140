"""Scoring with a frozen contract: validate, engineer, align, score, label.

The same functions take a batch table or a stream. Invalid rows are routed with their reasons instead of
failing the job, or raise in strict mode.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rarelens.contracts import FeatureContract, ThresholdPolicy, align_strict
from rarelens.functions.features import decision_label
from rarelens.operators.ingest import lookup, non_finite_reasons
from rarelens.plans.estimators import engineer

Scorer = Callable[[DataFrame], DataFrame]


class LogisticScorer(Transformer, HasInputCols, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """A linear-logistic model as one column expression."""

    weights = Param(Params._dummy(), "weights", "one weight per input column", TypeConverters.toListFloat)
    intercept = Param(Params._dummy(), "intercept", "intercept", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCols=(), weights=(), intercept=0.0, outputCol="fraud_probability"):
        super().__init__()
        self._set(inputCols=list(inputCols), weights=list(weights), intercept=intercept, outputCol=outputCol)

    def margin(self) -> Column:
        total: Column = F.lit(self.getOrDefault(self.intercept))
        for c, w in zip(self.getInputCols(), self.getOrDefault(self.weights)):
            total = total + F.lit(w) * F.col(c)
        return total

    def _transform(self, df: DataFrame) -> DataFrame:
        # exp of a large positive number would overflow to infinity and still give 0.0, as wanted.
        return df.withColumn(self.getOutputCol(), F.lit(1.0) / (F.lit(1.0) + F.exp(-self.margin())))


def positive_score(df: DataFrame, output: str = "score") -> DataFrame:
    """The continuous score of whatever a classifier emits.

    `probability` gives P(class 1); otherwise `rawPrediction` is rescaled to 0..1 over the table, otherwise
    the hard prediction is used.
    """
    if "probability" in df.columns:
        return df.withColumn(output, vector_to_array("probability")[1])
    if "rawPrediction" in df.columns:
        from rarelens.functions.features import min_max
        raw = df.withColumn("_raw", vector_to_array("rawPrediction")[1])
        ends = raw.agg(F.struct(F.min("_raw").alias("lo"), F.max("_raw").alias("hi"))).scalar()
        return raw.withColumn(output, min_max("_raw", ends["lo"], ends["hi"])).drop("_raw")
    if "prediction" in df.columns:
        return df.withColumn(output, F.col("prediction").cast("double"))
    raise ValueError("no probability, rawPrediction or prediction column to score from")


def row_reasons(contract: FeatureContract) -> Column:
    """Why a raw row cannot be scored; an empty array when it can."""
    rules = []
    for c in ("Time", "Amount"):
        if c in contract.raw:
            rules.append(F.when(F.col(c).try_cast("double") < 0, F.lit(f"{c}: negative")))
    negatives = F.array_compact(F.array(*rules)) if rules else F.array().cast("array<string>")
    return F.concat(non_finite_reasons(contract.raw), negatives)


def parse_payloads(df: DataFrame, contract: FeatureContract, text: str = "payload") -> DataFrame:
    """JSON payloads to raw columns plus `reasons` (missing and unexpected fields, bad values)."""
    fields = F.from_json(F.col(text), "map<string,string>")
    parsed = df.withColumn("_m", fields)
    names = F.array(*[F.lit(c) for c in contract.raw])
    keys = F.coalesce(F.map_keys("_m"), F.array().cast("array<string>"))
    label = lambda prefix: (lambda c: F.concat(F.lit(prefix), c))
    missing = F.transform(F.array_except(names, keys), label("missing field: "))
    unexpected = F.transform(F.array_sort(F.array_except(keys, names)), label("unexpected field: "))
    # Bare NaN and Infinity tokens come out of the parser in quotes.
    value = lambda c: F.regexp_replace(F.col("_m")[c], '^"(NaN|[+-]?Infinity)"$', "$1").alias(c)
    raw = parsed.select(*df.columns, F.col("_m").isNull().alias("_broken"), missing.alias("_missing"),
                        unexpected.alias("_unexpected"), *[value(c) for c in contract.raw])
    shape = F.concat("_missing", "_unexpected")
    reasons = (F.when(F.col("_broken"), F.array(F.lit("payload is not a JSON object")))
               .when(F.size(shape) > 0, shape).otherwise(row_reasons(contract)))
    return raw.withColumn("reasons", reasons).drop("_broken", "_missing", "_unexpected")


def parse_typed_payloads(df: DataFrame, contract: FeatureContract, text: str = "payload") -> DataFrame:
    """JSON payloads to raw columns (doubles) plus `reasons`, judged by the type of each value as it was written.

    Values are parsed once into variants: a quoted number, a boolean, a list or an object is not a number, whatever its text,
    and a number too large for a double is infinite. A payload that is not one object with distinct keys, or that holds bare
    NaN or Infinity, is not a JSON object. Missing and unexpected fields are reported together with bad values.
    """
    object_of = F.try_variant_get(F.try_parse_json(F.col(text)), "$", "map<string,variant>")
    is_object = F.ltrim(F.col(text)).startswith("{")
    parsed = df.withColumn("_m", F.when(is_object, object_of))
    names = F.array(*[F.lit(c) for c in contract.raw])
    keys = F.coalesce(F.map_keys("_m"), F.array().cast("array<string>"))
    label = lambda prefix: (lambda c: F.concat(F.lit(prefix), c))
    missing = F.transform(F.array_except(names, keys), label("missing field: "))
    unexpected = F.transform(F.array_sort(F.array_except(keys, names)), label("unexpected field: "))
    values = {c: F.try_variant_get(F.col("_m")[c], "$", "double") for c in contract.raw}
    rules = []
    for c in contract.raw:
        kind = F.schema_of_variant(F.col("_m")[c])
        named = (F.when(kind == "VOID", "null").when(kind == "STRING", "string, not a number").when(kind == "BOOLEAN", "boolean, not a number")
                 .when(kind.startswith("ARRAY"), "list, not a number").when(kind.startswith("OBJECT"), "object, not a number")
                 .when(F.abs(values[c]) == float("inf"), "infinite").when(values[c].isNull(), "not numeric"))
        if c in ("Time", "Amount"):
            named = F.coalesce(named, F.when(values[c] < 0, "negative"))
        rules.append(F.when(F.array_contains(keys, c), F.concat(F.lit(f"{c}: "), named)))
    reasons = F.when(F.col("_m").isNull(), F.array(F.lit("payload is not a JSON object"))).otherwise(
        F.concat(missing, unexpected, F.array_compact(F.array(*rules))))
    # only a value that is a number becomes one
    number = lambda c: F.when(F.schema_of_variant(F.col("_m")[c]).rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$"), values[c]).alias(c)
    own = [c for c in df.columns if c not in contract.raw]
    return parsed.select(*own, *[number(c) for c in contract.raw], reasons.alias("reasons"))


def with_reasons(df: DataFrame, contract: FeatureContract) -> DataFrame:
    return df.withColumn("reasons", row_reasons(contract))


def valid_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("reasons") == 0).drop("reasons")


def quarantined_rows(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("reasons") > 0)


def enforce_valid(checked: DataFrame) -> DataFrame:
    """Strict mode: an invalid row raises its reasons."""
    fail = F.raise_error(F.concat(F.lit("invalid row: "), F.array_join("reasons", "; "))).cast("boolean")
    return checked.where(F.when(F.size("reasons") == 0, F.lit(True)).otherwise(fail)).drop("reasons")


def score_rows(df: DataFrame, model: Transformer, policy: ThresholdPolicy, contract: FeatureContract,
               keep: Sequence[str] = (), model_version: str = "1", output: str = "fraud_probability",
               reasons: bool = False) -> DataFrame:
    """Raw rows to `keep` + (model_version, threshold_policy, threshold_used, fraud_probability, predicted_label).

    Every row is validated first. A row that cannot be scored keeps its place with a NULL probability and label; `reasons`
    appends why (an empty array for scored rows), so callers can route it to quarantine.
    """
    checked = df.withColumn("_reasons", row_reasons(contract))
    sound = F.size("_reasons") == 0
    # A stand-in value lets models that reject NULL pass over the row; its score is dropped below.
    numeric = checked.withColumns({c: F.when(sound, F.col(c).try_cast("double")).otherwise(0.0) for c in contract.raw if c not in keep})
    numeric = numeric.withColumns({c: F.when(sound, F.col(c).try_cast("double")) for c in contract.raw if c in keep})
    features = align_strict(engineer(numeric, negatives="reject"), contract.model,
                            [c for c in [*keep, "_reasons"] if c not in contract.model])
    scored = model.transform(features)
    if output not in scored.columns:
        scored = positive_score(scored, output)
    return scored.select(
        *keep, F.lit(model_version).alias("model_version"), F.lit(policy.name).alias("threshold_policy"),
        F.lit(float(policy.threshold)).alias("threshold_used"), F.when(sound, F.col(output)).alias("fraud_probability"),
        F.when(sound, decision_label(F.col(output), float(policy.threshold))).alias("predicted_label"),
        *([F.col("_reasons").alias("reasons")] if reasons else []))


def score_by_id(table: DataFrame, ids: DataFrame, model: Transformer, policy: ThresholdPolicy,
                contract: FeatureContract, key: str = "row_id", target: str = "Class") -> DataFrame:
    """Requested ids scored with their true label; ids without a row keep status "not_found"."""
    found = lookup(table.select(key, target, *[c for c in contract.raw]), ids.select(key), key)
    hits = found.where(F.col("status") == "found")
    scored = score_rows(hits, model, policy, contract, [key, target]).withColumnRenamed(target, "true_label")
    return found.select(key, "status").join(scored, key, "left")


