import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from rarelens.operators.splits import k_folds
from rarelens.plans import models, search
from rarelens.plans.estimators import PopulationScaler
from rarelens.plans.fitonly import OverSampler, PassThrough, SpecEstimator, TrainingPipeline

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(400, 3)) * [1, 5, 20] + [0, 3, -7]
    y = (rng.random(400) < 0.1).astype(int)
    x[y == 1] += [2, 5, 10]
    return spark.createDataFrame([(i, int(y[i]), *map(float, x[i])) for i in range(400)], "row_id long, Class int, a double, b double, c double").cache()


def spec(**more):
    options = {"scaler": "standard", "weights": "balanced", "resample": {"key": "row_id", "ratio": 0.5, "k": 3}, **more}
    return models.ModelSpec("logreg", {"max_iter": 30}, NAMES, **options)


def test_scaler_sees_raw_rows_and_scoring_keeps_rows(rows):
    model = spec().fit(rows)
    raw = rows.agg(*[f(c) for c in NAMES for f in (F.avg, F.stddev_pop)]).first()
    assert model.stages[0].getOrDefault("centers") == pytest.approx(raw[0::2]) and model.stages[0].getOrDefault("scales") == pytest.approx(raw[1::2])
    assert not any(isinstance(s, (OverSampler, PassThrough)) for s in model.stages)
    scored = models.score_model(model, rows, keep=["row_id"])
    assert scored.count() == 400 and scored.select("row_id").distinct().count() == 400


def test_training_rows_and_weights_behind_the_sampler(rows):
    one = spec()
    _, grown = TrainingPipeline(stages=one.steps()).prepare(one.training_table(rows, ["row_id"]))
    counts = {r["label"]: (r["n"], r["w"], r["made"]) for r in grown.groupBy("label").agg(
        F.count("*").alias("n"), F.max("_weight").alias("w"), F.count(F.when(F.col("row_id").isNull(), 1)).alias("made")).collect()}
    zero, ones = rows.where("Class = 0").count(), rows.where("Class = 1").count()
    assert counts[0.0][0] == zero and counts[1.0][0] == zero // 2 and counts[1.0][2] == zero // 2 - ones and counts[0.0][2] == 0
    n = zero + zero // 2
    assert counts[0.0][1] == pytest.approx(n / (2 * zero)) and counts[1.0][1] == pytest.approx(n / (2 * (zero // 2)))


def test_plain_pipeline_would_pass_rows_through(rows):
    """The sampler as a stage of Spark's own pipeline changes nothing; in a training pipeline it changes the fit only."""
    data = rows.withColumn("label", F.col("Class").cast("double"))
    sampler = OverSampler(NAMES, "label", "row_id", ratio=0.5, k=3)
    scale = PopulationScaler(inputCols=NAMES, outputCols=[f"{c}_s" for c in NAMES])
    plain = Pipeline(stages=[sampler, scale]).fit(data).stages[-1].getOrDefault("centers")
    grown = TrainingPipeline(stages=[sampler, scale]).fit(data)
    assert plain != pytest.approx(grown.stages[-1].getOrDefault("centers")) and grown.transform(data).count() == 400


def test_folds_learn_from_their_training_rows_only(rows):
    """Every fold's average precision equals that of a fit on the other folds, weights and sampling included."""
    one = spec()
    result = search.cross_validate(one, rows, ["row_id"], [{"C": 0.01}, {"C": 10.0}, {"C": 10.0, "threshold": 0.9}], folds=2)
    folded = k_folds(rows, "Class", ["row_id"], 2, "_fold")
    for i, c in enumerate((0.01, 10.0)):
        values = []
        for f in range(2):
            fitted = models.ModelSpec("logreg", {"max_iter": 30, "C": c}, NAMES, scaler="standard", weights="balanced", resample=one.resample).fit(folded.where(f"_fold <> {f}"))
            values.append(search.average_precision(models.score_model(fitted, folded.where(f"_fold = {f}"))).first()[0])
        got = {r["candidate"]: r["mean_test_score"] for r in result.table.collect()}
        assert got[i] == pytest.approx(np.mean(values), abs=1e-6)
    assert got[1] == pytest.approx(got[2]) and got[0] != pytest.approx(got[1], abs=1e-9)


def test_inside_a_cross_validator(rows):
    estimator = SpecEstimator(spec())
    table = rows.withColumn("label", F.col("Class").cast("double"))
    found = CrossValidator(estimator=estimator, estimatorParamMaps=estimator.maps([{}]), evaluator=models.AveragePrecisionEvaluator(), numFolds=2).fit(table)
    assert 0 < found.avgMetrics[0] <= 1
    with pytest.raises(ValueError):
        spec().fit(rows, rows)
