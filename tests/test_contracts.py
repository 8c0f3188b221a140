import json
import math

import pytest
from pyspark.sql import functions as F

from rarelens import contracts
from rarelens.contracts import ContractError, FeatureContract, ThresholdPolicy
from rarelens.functions import features as fx
from rarelens.operators import ingest, profile
from rarelens.plans import estimators, scoring
from rarelens.plans.scoring import LogisticScorer

RAW = ["Time", "V1", "V2", "Amount"]
ENGINEERED = ["Hour", "hour_sin", "hour_cos", "Amount_log1p"]
CONFIG = {"raw_input_features": RAW, "engineered_features": ENGINEERED, "model_features": RAW + ENGINEERED}
CONTRACT = FeatureContract.from_config(CONFIG)
PAYLOAD = {"Time": 7200.0, "V1": 1.5, "V2": -0.25, "Amount": 99.0}
MODEL = LogisticScorer(inputCols=RAW + ENGINEERED, weights=[0.0] * 8, intercept=math.log(4))  # probability 0.8
POLICY = ThresholdPolicy("p", 0.5)


def payloads(spark, *items):
    rows = [(i, p if isinstance(p, str) else json.dumps(p)) for i, p in enumerate(items)]
    return scoring.parse_payloads(spark.createDataFrame(rows, "row_id long, payload string"), CONTRACT)


def table(spark, **changes):
    row = {**PAYLOAD, **changes}
    return spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} double" for k in row))


def test_valid_schema_is_accepted():
    assert CONTRACT.model == tuple(RAW + ENGINEERED)


@pytest.mark.parametrize("change,message", [
    ({"raw_input_features": ["Time", "V1", "V1", "Amount"]}, "duplicate"),
    ({"model_features": ["Time", "V2", "V1", "Amount"] + ENGINEERED}, "in order"),
    ({"engineered_features": "Hour"}, "list of strings"), ({"raw_input_features": ["Time", 3]}, "list of strings")])
def test_bad_schemas_are_rejected(change, message):
    with pytest.raises(ContractError, match=message):
        FeatureContract.from_config({**CONFIG, **change})


def test_schema_needs_all_keys_and_a_mapping():
    with pytest.raises(ContractError, match="lacks keys"):
        FeatureContract.from_config({"raw_input_features": RAW})
    with pytest.raises(ContractError, match="mapping"):
        FeatureContract.from_config([])


def test_repeated_names_follow_discovery_order():
    assert contracts.repeated(["b", "a", "a", "b", "a", "c"]) == ["a", "b"]


@pytest.mark.parametrize("change,message", [
    ({"threshold": "0.5"}, "numeric"), ({"threshold": 1.2}, r"\[0, 1\]"), ({"reference_model_artifact": " "}, "non-empty")])
def test_bad_policies_are_rejected(change, message):
    good = {"policy_name": "p", "policy_version": "1", "threshold": 0.1279, "reference_model_artifact": "m"}
    assert ThresholdPolicy.from_config(good).threshold == 0.1279
    with pytest.raises(ContractError, match=message):
        ThresholdPolicy.from_config({**good, **change})
    with pytest.raises(ContractError, match="lacks keys"):
        ThresholdPolicy.from_config({"threshold": 0.5})


def test_engineered_values(spark):
    r = estimators.engineer(table(spark)).first()
    assert r["Hour"] == 2 and r["Amount_log1p"] == pytest.approx(math.log1p(99))
    assert r["hour_sin"] == pytest.approx(math.sin(2 * math.pi * 2 / 24))
    assert r["hour_cos"] == pytest.approx(math.cos(2 * math.pi * 2 / 24))


def test_negative_amount_clips_or_raises(spark):
    assert estimators.engineer(table(spark, Amount=-5.0)).first()["Amount_log1p"] == 0.0
    with pytest.raises(Exception, match="non-negative"):
        estimators.engineer(table(spark, Amount=-5.0), negatives="reject").collect()


@pytest.mark.parametrize("seconds,hour", [(0.0, 0), (3599.9, 0), (86399.0, 23), (86400.0, 0), (-1.0, 23), (-86401.0, 23)])
def test_hour_wraps_like_a_clock(spark, seconds, hour):
    assert spark.createDataFrame([(seconds,)], "t double").select(fx.hour_of_day("t")).first()[0] == hour


def test_strict_alignment_reorders_and_reports_missing(spark):
    df = table(spark).select("Amount", "V2", "V1", "Time")
    assert contracts.align_strict(df, RAW).columns == RAW
    with pytest.raises(ContractError, match="V9"):
        contracts.align_strict(df, ["Time", "V9"])


def test_lenient_alignment_fills_and_drops(spark):
    out, info = contracts.align_lenient(table(spark), ["Amount", "V9"])
    assert out.first().asDict() == {"Amount": 99.0, "V9": 0.0}
    assert (info.dropped, info.missing_filled, info.expected_count) == (["Time", "V1", "V2"], ["V9"], 2)


def test_target_discovery_is_case_sensitive(spark):
    assert contracts.find_target(spark.createDataFrame([(1, 2)], "x int, is_fraud int")) == "is_fraud"
    with pytest.raises(ContractError):
        contracts.find_target(spark.createDataFrame([(1,)], "CLASS int"))
    with pytest.raises(ContractError, match="missing required"):
        contracts.require_columns(table(spark), ["Amount", "Class"])
    assert contracts.column_differences(table(spark), ["Time", "V7"]) == (["V7"], ["Amount", "V1", "V2"])


def test_payload_reasons(spark):
    without = {k: v for k, v in PAYLOAD.items() if k != "V1"}
    got = {r["row_id"]: r["reasons"] for r in payloads(
        spark, PAYLOAD, without, {**PAYLOAD, "z": 1, "b": 2}, {**PAYLOAD, "V1": "abc"}, {**PAYLOAD, "V1": float("nan")},
        {**PAYLOAD, "Amount": float("inf")}, {**PAYLOAD, "Time": -1}, {**PAYLOAD, "V2": None}, "oops").collect()}
    assert got == {
        0: [], 1: ["missing field: V1"], 2: ["unexpected field: b", "unexpected field: z"], 3: ["V1: not numeric"],
        4: ["V1: NaN"], 5: ["Amount: infinite"], 6: ["Time: negative"], 7: ["V2: missing"],
        8: ["payload is not a JSON object"]}


def test_scoring_is_deterministic_and_labelled(spark):
    good = scoring.valid_rows(payloads(spark, PAYLOAD, PAYLOAD))
    rows = scoring.score_rows(good, MODEL, POLICY, CONTRACT, ["row_id"]).collect()
    assert rows[0]["fraud_probability"] == rows[1]["fraud_probability"] == pytest.approx(0.8)
    assert rows[0]["predicted_label"] == "fraud"
    low = LogisticScorer(inputCols=["Hour"], weights=[0.0], intercept=-math.log(9))
    assert scoring.score_rows(good, low, POLICY, CONTRACT, ["row_id"]).first()["predicted_label"] == "legit"


def test_score_on_the_threshold_is_an_alert(spark):
    half = LogisticScorer(inputCols=["Hour"], weights=[0.0], intercept=0.0)
    assert scoring.score_rows(table(spark), half, POLICY, CONTRACT).first()["predicted_label"] == "fraud"


def test_score_by_id_reports_missing_ids(spark):
    t = table(spark).withColumns({"row_id": F.lit(1).cast("long"), "Class": F.lit(0)})
    rows = {r["row_id"]: r for r in scoring.score_by_id(
        t, spark.createDataFrame([(1,), (9,)], "row_id long"), MODEL, POLICY, CONTRACT).collect()}
    assert rows[1]["true_label"] == 0 and rows[1]["fraud_probability"] == pytest.approx(0.8)
    assert rows[9]["status"] == "not_found" and rows[9]["fraud_probability"] is None


def test_strict_modes_raise(spark):
    bad = table(spark, Amount=float("nan"))
    with pytest.raises(Exception, match="NaN"):
        ingest.reject_non_finite(bad, RAW).collect()
    with pytest.raises(Exception, match="NaN"):
        scoring.enforce_valid(scoring.with_reasons(bad, CONTRACT)).collect()
    found = ingest.lookup(spark.range(3).withColumnRenamed("id", "row_id"), spark.createDataFrame([(7,)], "row_id long"))
    with pytest.raises(Exception, match="not found"):
        ingest.require_found(found).collect()


def test_gate(spark):
    rows = [(1.0, 0), (1.0, 0), (-2.0, 1), (None, 1)]
    df = spark.createDataFrame(rows, "Amount double, Class int")
    gate = {r["rule"]: (r["value"], r["passed"]) for r in profile.quality_gate(df, max_duplicates=1).collect()}
    assert gate == {"nulls": (1, False), "duplicates": (1, True), "negative_amounts": (1, False)}
    with pytest.raises(ContractError, match="nulls=1"):
        profile.enforce_gate(profile.quality_gate(df))
    profile.enforce_gate(profile.quality_gate(df.na.drop().where("Amount > 0").distinct()))


def test_text_targets(spark):
    two = spark.createDataFrame([("yes",), ("no",), ("yes",)], "y string")
    assert [r["Class"] for r in ingest.binary_target(two, "y").collect()] == [1, 0, 1]
    many = spark.createDataFrame([("1",), ("0",), ("2",)], "y string")
    assert sorted(r["Class"] for r in ingest.binary_target(many, "y").collect()) == [0, 1, 2]
    with pytest.raises(Exception, match="not a binary target"):
        ingest.binary_target(spark.createDataFrame([("a",), ("b",), ("c",)], "y string"), "y").collect()


def test_integral_coercion(spark):
    df = spark.createDataFrame([("1",), ("2.0",), ("x",), (None,)], "v string")
    r = ingest.coercion_summary(df, "v").first()
    assert (r["kept"], r["dropped"], r["all_integral"]) == (2, 2, True)
    assert ingest.drop_uncoercible(df, "v").count() == 2


@pytest.mark.parametrize("amounts,method", [([1.0] * 9 + [500.0], "logz"), ([1.0, 2.0, 3.0, 4.0], "zscore")])
def test_auto_scaling_follows_skew(spark, amounts, method):
    df = spark.createDataFrame([(a,) for a in amounts], "Amount double")
    model = estimators.AutoScaler().fit(df)
    out = [r[0] for r in model.transform(df).select("Amount_scaled").collect()]
    assert model.method == method
    assert sum(out) == pytest.approx(0.0, abs=1e-9) and sum(v * v for v in out) / len(out) == pytest.approx(1.0)


def test_constant_column_is_only_centred(spark):
    df = spark.createDataFrame([(5.0,)] * 3, "Amount double")
    out = estimators.PopulationScaler(inputCols=["Amount"], outputCols=["s"]).fit(df).transform(df)
    assert {r["s"] for r in out.collect()} == {0.0}


def test_stages_save_and_load(spark, tmp_path):
    df = spark.createDataFrame([(float(i), float(i * 400)) for i in range(200)], "Amount double, Time double")
    for i, stage in enumerate([estimators.AmountFeatures().fit(df), estimators.TimeFeatures(), estimators.AutoScaler().fit(df),
                               estimators.ServingFeatures(),
                               estimators.RobustColumnScaler(inputCols=["Amount"], outputCols=["r"]).fit(df)]):
        path = str(tmp_path / f"s{i}")
        stage.write().save(path)
        again = type(stage).load(path)
        assert again.transform(df).collect() == stage.transform(df).collect()


def test_amount_features_learn_on_train_only(spark):
    train = spark.createDataFrame([(float(i),) for i in range(101)], "Amount double")
    other = spark.createDataFrame([(90.0,), (90.5,), (50.0,), (99.0,), (1e9,)], "Amount double")
    rows = estimators.AmountFeatures().fit(train).transform(other).collect()
    assert [r["amount_gt_90"] for r in rows] == [0, 1, 0, 1, 1]  # strictly above
    assert [r["amount_bin"] for r in rows] == [2, 2, 1, 3, 3]  # at or above


def test_typed_payload_reasons(spark):
    texts = ['{"Time": 1, "Amount": 2.5}', '{"Time": 1, "Amount": 2, "Amount": 3}', '{"Amount": "2"}', '{"Time": [], "Amount": {"Amount": 1}, "x": {"y": 1}}',
             '{"Time": 1e400, "Amount": -1}', '{"Time": 12345678901234567890123, "Amount": false}', "", None, " {}", '{"Time": 1.5e2, "Amount": null}', "[]"]
    df = spark.createDataFrame(list(enumerate(texts)), "row_id long, payload string")
    contract = scoring.FeatureContract(raw=("Time", "Amount"), version="t")
    got = {r["row_id"]: (r["Time"], r["Amount"], r["reasons"]) for r in scoring.parse_typed_payloads(df, contract).collect()}
    broken = (None, None, ["payload is not a JSON object"])
    assert got == {
        0: (1.0, 2.5, []), 1: broken, 2: (None, None, ["missing field: Time", "Amount: string, not a number"]),
        3: (None, None, ["unexpected field: x", "Time: list, not a number", "Amount: object, not a number"]),
        4: (float("inf"), -1.0, ["Time: infinite", "Amount: negative"]), 5: (12345678901234567890123.0, None, ["Amount: boolean, not a number"]),
        6: broken, 7: broken, 8: (None, None, ["missing field: Time", "missing field: Amount"]), 9: (150.0, None, ["Amount: null"]), 10: broken}
