import math

import numpy as np
import pytest
from pyspark.ml.classification import LinearSVC
from pyspark.sql import functions as F

from rarelens.functions.features import hash_unit
from rarelens.operators import evaluation, splits
from rarelens.plans import explain, models, search
from rarelens.plans.scoring import LogisticScorer, positive_score

FEATURES = ("a", "b")


@pytest.fixture(scope="module")
def table(spark):
    """A separable-ish problem drawn from row digests."""
    a, b = hash_unit("row_id", seed="a") * 4 - 2, hash_unit("row_id", seed="b") * 4 - 2
    rows = spark.range(600).withColumnRenamed("id", "row_id").withColumns({"a": a, "b": b})
    noisy = F.col("a") * 2 - F.col("b") + hash_unit("row_id", seed="noise") * 2 - 1
    return rows.withColumn("Class", (noisy > 1.5).cast("int"))


@pytest.fixture(scope="module")
def parts(table):
    out = splits.three_way_split(table, "Class", ["row_id"], 0.25, 0.25)
    return {s: out.where(F.col("split") == s).drop("split") for s in ("train", "val", "test")}


@pytest.mark.parametrize("family,params", [
    ("logreg", {"C": 1.0, "max_iter": 50}), ("decision_tree", {"max_depth": 5}),
    ("random_forest", {"n_estimators": 10, "max_depth": 5}), ("boosted_trees", {"n_estimators": 5, "max_depth": 3})])
def test_families_learn(parts, family, params):
    spec = models.ModelSpec(family, params, FEATURES, scaler="standard", weights="balanced")
    r = evaluation.evaluate(models.score_model(spec.fit(parts["train"]), parts["test"]), 0.5).first()
    assert r["roc_auc"] > 0.9 and r["n"] == 150


def test_logistic_penalty_matches_the_summed_loss(spark, parts):
    """Minimise C * sum(loss) + |w|^2 / 2 directly and compare."""
    c = 0.05
    train = parts["train"]
    model = models.ModelSpec("logreg", {"C": c, "max_iter": 200, "tol": 1e-9}, FEATURES).fit(train)
    got = model.stages[-1].coefficients.toArray()
    rows = train.collect()
    x = np.array([[1.0, r["a"], r["b"]] for r in rows])
    y = np.array([r["Class"] for r in rows])
    w = np.zeros(3)
    ridge = np.diag([0.0, 1.0, 1.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        w -= np.linalg.solve(c * (x * (p * (1 - p))[:, None]).T @ x + ridge, c * x.T @ (p - y) + ridge @ w)
    assert got == pytest.approx(w[1:], abs=1e-3)


def test_early_stopping_uses_no_more_trees(parts):
    spec = models.ModelSpec("boosted_trees", {"n_estimators": 15, "max_depth": 3, "learning_rate": 1.0}, FEATURES)
    assert spec.fit(parts["train"], parts["val"]).stages[-1].getNumTrees <= 15


def test_save_load_expected_features_and_rules(spark, parts, tmp_path):
    spec = models.ModelSpec("decision_tree", {"max_depth": 3, "min_leaf": 10}, FEATURES, scaler="robust")
    model = spec.fit(parts["train"])
    models.save_model(model, str(tmp_path / "m"))
    again = models.load_model(str(tmp_path / "m"))
    assert models.expected_features(again) == ["a", "b"]
    want = models.score_model(model, parts["test"], keep=["row_id"]).orderBy("row_id").collect()
    assert models.score_model(again, parts["test"], keep=["row_id"]).orderBy("row_id").collect() == want
    assert "If (a <=" in models.tree_rules(model) or "If (b <=" in models.tree_rules(model)
    assert "feature " not in models.tree_rules(model)
    top = models.importances(model, spark).collect()
    assert top[0]["feature"] == "a" and sum(r["importance"] for r in top) == pytest.approx(1.0)


def test_scores_fall_back_to_raw_and_hard_predictions(spark, parts):
    spec = models.ModelSpec(lambda **p: LinearSVC(featuresCol="features", labelCol="label", maxIter=10), {}, FEATURES)
    scored = models.score_model(spec.fit(parts["train"]), parts["test"])
    r = scored.agg(F.min("score"), F.max("score")).first()
    assert r[0] == 0.0 and r[1] == pytest.approx(1.0)
    hard = spark.createDataFrame([(1.0,)], "prediction double")
    assert positive_score(hard).first()["score"] == 1.0
    with pytest.raises(ValueError):
        positive_score(spark.range(1))


def test_search_ranks_and_refits(parts, table):
    spec = models.ModelSpec("decision_tree", {}, FEATURES, weights="balanced")
    options = search.grid({"maxDepth": [1, 5]})
    result = search.cross_validate(spec, table, ["row_id"], options, 3)
    rows = result.table.collect()
    assert result.best_params == {"maxDepth": 5} and [r["rank"] for r in rows] == [1, 2]
    assert result.best_score == rows[0]["mean_test_score"] > rows[1]["mean_test_score"]
    assert search.top_params(result, options, 1) == [{"maxDepth": 5}]
    log = search.refit_top(spec, [{"max_depth": 5}], parts["train"], parts["val"], parts["test"], 0.6).collect()
    assert {r["stage"] for r in log} == {f"{s}_top1_{t}" for s in ("valid", "test") for t in ("maxF2", "precision>=0.6")}
    for tag in ("maxF2", "precision>=0.6"):
        pair = {r["stage"].split("_")[0]: r["threshold"] for r in log if r["stage"].endswith(tag)}
        assert pair["valid"] == pair["test"]
    beyond = search.refit_top(spec, [{"max_depth": 2}], parts["train"], parts["val"], parts["test"], 1.1).collect()
    assert {r["stage"] for r in beyond} == {"valid_top1_maxF2", "test_top1_maxF2"}


def test_draws_are_seeded_and_distinct():
    options = {"a": [1, 2, 3], "b": ["x", "y"]}
    picks = search.draw(options, 4, 1)
    assert picks == search.draw(options, 4, 1) and len({tuple(p.items()) for p in picks}) == 4
    assert sorted(map(str, search.draw(options, 99))) == sorted(map(str, search.grid(options)))


def test_ab_rows_and_summary(parts):
    spec = models.ModelSpec("decision_tree", {"max_depth": 3}, FEATURES)
    rows, summary = search.ab_test(spec, {"one": ["b"], "both": ["a", "b"]}, parts, [1, 2], 0.7)
    assert rows.count() == 4
    means = {r["run"]: r["pr_auc_mean"] for r in summary.collect()}
    assert means["both"] > means["one"]


def test_equal_c_scores_keep_the_first(parts):
    best, _ = search.pick_c(models.ModelSpec("logreg", {"max_iter": 5}, FEATURES), parts["train"], parts["val"], [1e12, 1e13])
    assert best == 1e12


# Explanations ------------------------------------------------------------------------------------------------

MODEL = LogisticScorer(inputCols=["a", "b"], weights=[2.0, -1.0], intercept=0.1)


class Linear(LogisticScorer):
    def _transform(self, df):
        return df.withColumn("fraud_probability", self.margin())


def test_case_picker_ties_and_absent_kinds(spark):
    df = spark.createDataFrame([(5, 1, 0.9), (2, 1, 0.9), (3, 0, 0.6), (4, 0, 0.4)], "row_id long, label int, score double")
    got = {r["name"]: r["row_index"] for r in explain.pick_cases(df, 0.5).collect()}
    assert got == {"true_positive": 2, "true_negative": 4, "borderline": 3}
    only = {r["name"] for r in explain.pick_cases(df.where("label = 1 AND row_id = 5"), 0.95).collect()}
    assert only == {"borderline"}


def test_shapley_of_a_linear_model_is_exact_per_draw(spark, table):
    linear = Linear(inputCols=["a", "b"], weights=[2.0, -1.0], intercept=0.1)
    rows, background = table.where("row_id < 3"), table.where("row_id = 17")
    got = {(r["row_id"], r["feature"]): r["phi"] for r in explain.shapley_attributions(
        rows, background, linear, ["a", "b"], draws=4, background_size=1, score="fraud_probability").collect()}
    want = {(r["row_id"], r["feature"]): r["phi"] for r in explain.linear_attributions(
        rows, background, {"a": 2.0, "b": -1.0}).collect()}
    assert got == pytest.approx(want)


def test_shapley_adds_up_and_orders_importance(spark, table):
    rows = table.where("row_id < 5")
    phi = explain.shapley_attributions(rows, table, MODEL, ["a", "b"], draws=40, background_size=1, score="fraud_probability")
    from rarelens.operators.ingest import sample_exact
    stand_in = MODEL.transform(sample_exact(table, ["row_id"], 1, 42)).first()["fraud_probability"]
    total = {r["row_id"]: r["s"] for r in phi.groupBy("row_id").agg(F.sum("phi").alias("s")).collect()}
    for r in MODEL.transform(rows).collect():
        assert total[r["row_id"]] == pytest.approx(r["fraud_probability"] - stand_in)
    assert explain.global_importance(phi).first()["feature"] == "a"
    assert {r["feature"] for r in explain.dependence(phi, ["b"]).collect()} == {"b"}


def test_shapley_against_a_background_of_any_size(spark, table, monkeypatch):
    rows = table.where("row_id < 3")
    shape = lambda df: {(r["row_id"], r["feature"]): r["phi"] for r in df.collect()}
    run = lambda: shape(explain.shapley_attributions(rows, table, MODEL, ["a", "b"], draws=8, background_size=10 ** 6, score="fraud_probability"))
    joined = run()
    monkeypatch.setattr(explain, "BACKGROUND_BROADCAST", 10 ** 9)
    assert len(joined) == 6 and run() == pytest.approx(joined)
    # the mean over the drawn stand-ins, which are numbered by digest
    from rarelens.functions.features import hash_unit, stable_hash
    stand_ins = [r["s"] for r in MODEL.transform(table).orderBy(stable_hash("row_id", seed=42)).select(F.col("fraud_probability").alias("s")).collect()]
    draws = rows.select("row_id", F.explode(F.sequence(F.lit(1), F.lit(8))).alias("_draw")).withColumn("u", hash_unit("row_id", "_draw", seed="42-background")).collect()
    for r in MODEL.transform(rows).collect():
        picked = [stand_ins[int(d["u"] * len(stand_ins))] for d in draws if d["row_id"] == r["row_id"]]
        assert joined[(r["row_id"], "a")] + joined[(r["row_id"], "b")] == pytest.approx(r["fraud_probability"] - sum(picked) / len(picked))
    assert not shape(explain.shapley_attributions(rows, table.where("false"), MODEL, ["a", "b"], score="fraud_probability"))


def test_local_surrogate_terms(spark, table):
    cases = table.where("row_id IN (1, 2)")
    out = explain.local_surrogate(cases, table, MODEL, ["a", "b"], 0.5, samples=400, top=2, label="Class",
                                  score="fraud_probability").collect()
    assert len(out) == 4 and {r["rank"] for r in out} == {1, 2}
    truth = {r["row_id"]: r for r in MODEL.transform(cases).collect()}
    for r in out:
        t = truth[r["row_index"]]
        assert r["p_fraud"] == pytest.approx(t["fraud_probability"]) and r["true_label"] == t["Class"]
        assert r["pred_label"] == int(t["fraud_probability"] >= 0.5) and ("a" in r["term"] or "b" in r["term"])
        assert math.isfinite(r["weight"])
    for i in (1, 2):
        mine = sorted((r for r in out if r["row_index"] == i), key=lambda r: r["rank"])
        assert abs(mine[0]["weight"]) >= abs(mine[1]["weight"])
