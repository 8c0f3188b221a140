import math
import random

import pytest
from pyspark.sql import functions as F

from rarelens.operators import curves, evaluation, sweep, thresholds
from tests import brute


def scored(spark, y, s):
    return spark.createDataFrame(list(zip(map(int, y), map(float, s))), "label int, score double")


def cases():
    rng = random.Random(7)
    ties = [round(rng.random(), 1) for _ in range(300)]
    y = [int(rng.random() < 0.1 + 0.5 * v) for v in ties]
    fine = [rng.random() ** 8 for _ in range(500)]
    yf = [int(rng.random() < 0.05 + 0.5 * v) for v in fine]
    hot = [0.25 if i % 3 == 0 else rng.random() for i in range(400)]
    yh = [int(rng.random() < 0.2) for _ in hot]
    return {"ties": (y, ties), "clustered": (yf, fine), "one hot score": (yh, hot),
            "no positives": ([0] * 20, [i / 20 for i in range(20)]), "all positives": ([1] * 9, [0.5] * 4 + [0.1] * 5),
            "all tied": ([1, 0, 1, 0, 0], [0.4] * 5), "single row": ([1], [0.3])}


def all_cases(spark):
    """Every case as one group of a single table."""
    rows = [(g, int(a), float(b)) for g, (y, s) in cases().items() for a, b in zip(y, s)]
    return spark.createDataFrame(rows, "g string, label int, score double")


@pytest.mark.parametrize("buckets", [2, 64])
def test_curve_and_ranking_per_group(spark, buckets):
    curve = curves.score_curve(all_cases(spark), by=["g"], buckets=buckets)
    rows = curves.with_counts(curve).select("g", "threshold", "precision", "recall", "tp", "fp", "tn", "fn").collect()
    ranking = {r["g"]: r for r in curves.ranking_metrics(curve, ["g"]).collect()}
    for name, (y, s) in cases().items():
        got, want = sorted(tuple(r)[1:] for r in rows if r["g"] == name), brute.curve(y, s)
        assert [g[0] for g in got] == [w[0] for w in want]
        for g, w in zip(got, want):
            assert g[3:] == w[3:] and g[1] == pytest.approx(w[1]) and g[2] == pytest.approx(w[2])
        for field, value in (("pr_auc", brute.average_precision(y, s)), ("roc_auc", brute.roc_auc(y, s))):
            assert ranking[name][field] == (None if value is None else pytest.approx(value, abs=1e-12))
        assert ranking[name]["n"] == len(y)


def test_curve_when_offsets_may_not_be_broadcast(spark, monkeypatch):
    from rarelens.operators import ordered
    want = {tuple(r) for r in curves.score_curve(all_cases(spark), by=["g"]).collect()}
    monkeypatch.setattr(ordered, "BROADCAST_LINE_LIMIT", 0)
    assert {tuple(r) for r in curves.score_curve(all_cases(spark), by=["g"]).collect()} == want


def test_ungrouped_curve(spark):
    y, s = cases()["ties"]
    got = curves.ranking_metrics(curves.score_curve(scored(spark, y, s))).first()
    assert got["pr_auc"] == pytest.approx(brute.average_precision(y, s)) and got["roc_auc"] == pytest.approx(brute.roc_auc(y, s))


@pytest.mark.parametrize("target", [0.3, 0.9])
def test_policies_per_group(spark, target):
    curve = curves.score_curve(all_cases(spark), by=["g"])
    precision, recall, t = (lambda p: p[1]), (lambda p: p[2]), target
    enough, reached = (lambda p: p[1] >= t), (lambda p: p[2] >= t)
    rules = {
        "recall_target": (dict(target=t), lambda c: brute.best(c, precision, reached) or brute.best(c, recall)),
        "precision_or_null": (dict(target=t), lambda c: brute.best(c, recall, enough)),
        "precision_or_best": (dict(target=t), lambda c: brute.best(c, recall, enough) or brute.best(c, precision)),
        "precision_constraint": (dict(target=t), lambda c: brute.best(c, lambda p: 0, enough) or brute.best(c, precision)),
        "max_f1": ({}, lambda c: brute.best(c, lambda p: brute.f_beta(p, 1, False))),
        "max_fbeta": (dict(undefined_as_zero=True), lambda c: brute.best(c, lambda p: brute.f_beta(p, 2, True))),
        "cost_based": (dict(fn_cost=3.0), lambda c: brute.best(c, lambda p: -(p[4] + 3.0 * p[6]))),
    }
    points = {name: brute.curve(y, s) for name, (y, s) in cases().items()}
    for policy, (options, expected) in rules.items():
        got = {r["g"]: r for r in thresholds.select_threshold(curve, policy, ["g"], **options).collect()}
        for name, c in points.items():
            want = expected(c)
            assert got[name]["threshold"] == (want[0] if want else None), (policy, name)
            if want:
                assert tuple(got[name][k] for k in ("tp", "fp", "tn", "fn")) == want[3:], (policy, name)


def test_side_by_side_policies_equal_the_single_ones(spark):
    curve = curves.score_curve(all_cases(spark), by=["g"])
    together = {(r["g"], r["policy"]): r["threshold"] for r in thresholds.all_policies(curve, ["g"]).collect()}
    for policy in ("max_f1", "max_fbeta", "precision_constraint", "cost_based"):
        for r in thresholds.select_threshold(curve, policy, ["g"]).collect():
            assert together[r["g"], policy] == r["threshold"]


def test_constrained_bests_per_group(spark):
    curve = curves.score_curve(all_cases(spark), by=["g"])
    points = {name: brute.curve(y, s) for name, (y, s) in cases().items()}
    for r in thresholds.recall_at_precision(curve, [0.0, 0.4, 1.0], ["g"]).collect():
        assert r["recall"] == pytest.approx(max([p[2] for p in points[r["g"]] if p[1] >= r["target"]] + [0.0]))
    for r in thresholds.precision_at_recall(curve, [0.0, 0.4, 1.0], ["g"]).collect():
        floor = [1.0] if r["target"] <= 0 else [0.0]
        assert r["precision"] == pytest.approx(max([p[1] for p in points[r["g"]] if p[2] >= r["target"]] + floor))


def test_sweep_counts_include_scores_on_the_grid(spark):
    grid = sweep.threshold_grid()
    y, s = [1, 0, 1, 0, 1] * 4, [grid[0], grid[50], grid[50], grid[100], math.nextafter(grid[50], 0)] * 4
    rows = {r["threshold"]: r for r in sweep.sweep(scored(spark, y, s)).collect()}
    assert len(rows) == 101
    for t in grid:
        assert tuple(rows[t][c] for c in ("tp", "fp", "tn", "fn")) == brute.counts(y, s, t)


def test_sweep_ties_pick_the_lowest_threshold(spark):
    df = scored(spark, [1, 1, 0, 0], [0.9, 0.9, 0.1, 0.1])
    swept = sweep.sweep(df, [0.2, 0.5, 0.8])
    for mode in ("f1", "youden", "cost"):
        assert sweep.pick_from_sweep(swept, mode).first()["threshold"] == 0.2
    assert sweep.pick_from_sweep(swept, "none").first()["threshold"] is None
    with pytest.raises(ValueError):
        sweep.pick_from_sweep(swept, "best")


def test_infinite_scores_are_ordinary_thresholds(spark):
    y, s = [1, 0, 1, 0], [float("inf"), 0.2, 0.2, float("-inf")]
    assert curves.average_precision(scored(spark, y, s)).first()[0] == pytest.approx(brute.average_precision(y, s))
    assert sweep.counts_at(scored(spark, y, s), [0.5]).first()["tp"] == 1


@pytest.mark.parametrize("row", [(2, 0.5), (1, None), (1, float("nan")), (None, 0.5)])
def test_contract_violations_raise(spark, row):
    df = spark.createDataFrame([(0, 0.1), row], "label int, score double")
    with pytest.raises(Exception, match="label must be|score must be"):
        curves.as_scored(df).collect()


def test_empty_input(spark):
    df = spark.createDataFrame([], "label int, score double")
    assert curves.score_curve(df).count() == 0
    r = evaluation.evaluate(df, 0.5).first()
    assert (r["tp"], r["n"], r["pr_auc"], r["roc_auc"]) == (0, 0, None, None)
    assert evaluation.confusion(df, 0.5).first()["tn"] == 0
    assert thresholds.all_policies(curves.score_curve(df)).where("threshold IS NOT NULL").count() == 0


def test_published_arithmetic(spark):
    counts = spark.createDataFrame([(77, 16, 56635, 18)], "tp long, fp long, tn long, fn long")
    from rarelens.functions.rates import Confusion
    c = Confusion.of()
    r = evaluation.with_rates(counts).withColumns({
        "cost": c.cost_per_row(), "per_10k": c.alerts / c.total * 10000}).first()
    want = {"precision": 0.8279569892473119, "recall": 0.8105263157894737, "f1": 0.8191489361702128,
            "cost": 0.006626017692877031, "per_10k": 16.38882035738202, "f2": 0.81395, "mcc": 0.81890}
    for k, v in want.items():
        assert r[k] == pytest.approx(v, rel=1e-5)


def test_mcc_survives_counts_beyond_long_products(spark):
    big = 10 ** 12
    r = evaluation.with_rates(spark.createDataFrame([(big, big, big, big)], "tp long, fp long, tn long, fn long")).first()
    assert r["mcc"] == pytest.approx(0.0) and r["accuracy"] == 0.5


def test_locking_keeps_the_chosen_threshold(spark):
    from rarelens.contracts import ContractError
    from rarelens.plans.locking import choose, evaluate_locked
    val = scored(spark, [0, 0, 1, 1], [0.1, 0.4, 0.6, 0.9])
    test = scored(spark, [0, 1, 1], [0.7, 0.5, 0.8])
    policy = choose(val, "precision_constraint")
    assert policy.threshold == 0.6
    assert evaluate_locked(test, policy).first()["tp"] == 1
    with pytest.raises(ContractError):
        choose(val, "precision_or_null", target=1.1)


def test_registered_policy_is_selectable(spark):
    thresholds.register_policy("highest", lambda curve, by, **_: curve.groupBy(*by).agg(F.max("threshold").alias("threshold")))
    curve = curves.score_curve(scored(spark, [1, 0], [0.3, 0.7]))
    assert thresholds.select_threshold(curve, "highest").first()["threshold"] == 0.7
    with pytest.raises(ValueError):
        thresholds.select_threshold(curve, "unknown")


def test_top_share_never_splits_ties(spark):
    df = scored(spark, [1, 1, 0, 0, 1, 0, 0, 0, 0, 0], [0.9, 0.8, 0.8, 0.8, 0.5, 0.4, 0.3, 0.2, 0.1, 0.0])
    rows = {r["share"]: r for r in thresholds.at_top_share(curves.score_curve(df), [0.05, 0.2, 0.4]).collect()}
    assert (rows[0.05]["alerts"], rows[0.2]["alerts"], rows[0.4]["alerts"]) == (0, 1, 4)
    assert rows[0.4]["precision"] == 0.5


def test_curve_of_groups_with_edges_from_a_sample(spark, monkeypatch):
    """A table beyond the edge sample, by group: the curve, its metrics and the policies are those of all rows."""
    from rarelens.operators import ordered
    expected = {r["g"]: r for r in curves.ranking_metrics(curves.score_curve(all_cases(spark), by=["g"]), ["g"]).collect()}
    grouped = all_cases(spark).where("g in ('ties', 'clustered')").withColumnRenamed("g", "model")
    lines = evaluation.compare_models(grouped).collect()
    monkeypatch.setattr(ordered, "EDGE_SAMPLE", 100)
    monkeypatch.setattr(ordered, "bucket_count", lambda df: 4)
    curve = curves.score_curve(all_cases(spark), by=["g"])
    for r in curves.ranking_metrics(curve, ["g"]).collect():
        want = expected[r["g"]]
        assert (r["n"], r["pos"], r["thresholds"]) == (want["n"], want["pos"], want["thresholds"])
        assert r["pr_auc"] == pytest.approx(want["pr_auc"]) and r["roc_auc"] == pytest.approx(want["roc_auc"])
    assert len(curves.roc_curve(curve, ["g"]).collect()) == sum(r["thresholds"] + 1 for r in expected.values())
    assert {r["g"] for r in thresholds.precision_or_best(curve, ["g"], 0.3).collect()} == set(expected)
    again = {r["model"]: r for r in evaluation.compare_models(grouped).collect()}
    assert len(again) == 2
    for r in lines:
        numbers = [c for c in r.asDict() if c != "model"]
        assert [again[r["model"]][c] for c in numbers] == pytest.approx([r[c] for c in numbers], rel=1e-9)
