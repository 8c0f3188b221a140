import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rarelens.operators import trees
from rarelens.operators.trees import Growth
from rarelens.plans import ensembles, models

NAMES = [f"x{i}" for i in range(6)]


def data(n=2000, seed=1, missing=0.1):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, len(NAMES))), 2)
    y = (x[:, 0] * x[:, 1] + 0.5 * x[:, 2] + rng.normal(size=n) * 0.7 > 0.8).astype(float)
    x[rng.random(x.shape) < missing] = np.nan
    return x, y


def frame(spark, x, y, parts=4):
    rows = [(i, float(y[i]), *[None if math.isnan(v) else float(v) for v in x[i]]) for i in range(len(y))]
    return spark.createDataFrame(rows, "id long, y double, " + ", ".join(f"{c} double" for c in NAMES[:x.shape[1]])).repartition(parts, "id")


def plain_edges(x, bins=32):
    return [sorted(set(np.nanquantile(x[:, f], [i / bins for i in range(1, bins)], method="inverted_cdf").tolist())) for f in range(x.shape[1])]


def plain_tree(x, first, second, rows, g: Growth, edges, depth=0):
    """Nested (value, rows, feature, threshold, missing_left, left, right) by direct search of every edge."""
    a, b = first[rows].sum(), second[rows].sum()
    node = {"value": trees.leaf_value(g, a, b), "rows": len(rows)}
    if (g.max_depth is not None and depth >= g.max_depth) or len(rows) < g.min_split:
        return node
    obj = lambda r: float(trees._objective(g, first[r].sum(keepdims=True), second[r].sum(keepdims=True))[0])
    size = lambda r: second[r].sum() if g.criterion == "second_order" else (first[r] + second[r]).sum()
    best = None
    for f in range(x.shape[1]):
        v = x[rows, f]
        gone = np.isnan(v)
        for lost_left in (True, False) if gone.any() else (True,):
            for t in [*edges[f], math.inf]:
                left = np.where(gone, lost_left, (v < t) | math.isinf(t))
                l, r = rows[left], rows[~left]  # noqa: E741
                if min(len(l), len(r)) < max(g.min_leaf, 1) or min(size(l), size(r)) < g.min_child:
                    continue
                gain = obj(l) + obj(r) - obj(rows)
                if gain > 1e-9 and gain >= g.gamma and (best is None or gain > best[0] + 1e-9):
                    best = gain, f, t, lost_left, l, r
    if best is None:
        return node
    _, f, t, lost_left, l, r = best  # noqa: E741
    return {**node, "feature": f, "threshold": t, "missing_left": lost_left, "left": plain_tree(x, first, second, l, g, edges, depth + 1),
            "right": plain_tree(x, first, second, r, g, edges, depth + 1)}


def same(tree, node, plain):
    assert tree.rows[node] == plain["rows"] and tree.value[node] == pytest.approx(plain["value"], abs=1e-7)
    assert (tree.left[node] >= 0) == ("left" in plain)
    if "left" in plain:
        assert (tree.feature[node], tree.threshold[node], tree.missing_left[node]) == (plain["feature"], plain["threshold"], plain["missing_left"])
        same(tree, tree.left[node], plain["left"])
        same(tree, tree.right[node], plain["right"])


def plain_value(plain, row):
    while "left" in plain:
        v = row[plain["feature"]]
        left = plain["missing_left"] if math.isnan(v) else v < plain["threshold"] or math.isinf(plain["threshold"])
        plain = plain["left" if left else "right"]
    return plain["value"]


def logloss(y, m):
    return float(np.mean(np.log1p(np.exp(-np.abs(m))) + np.maximum(np.where(y == 1, -m, m), 0)))


@pytest.mark.parametrize("growth", [
    Growth(max_depth=3, min_child=1.0),
    Growth(max_depth=4, min_child=3.0, reg_lambda=2.0, reg_alpha=1.5, gamma=0.5, max_delta_step=0.7, min_split=40, min_leaf=7)])
def test_boosting_equals_plain_version(spark, growth):
    x, y = data()
    held = np.arange(len(y)) % 4 == 0
    edges = plain_edges(x[~held])
    df = frame(spark, x, y).withColumn("held", F.col("id") % 4 == 0)
    forest = ensembles.boost(df, NAMES, "y", validation="held", rounds=4, rate=0.4, growth=growth, metric="logloss", edges=edges)
    margin = np.zeros(len(y))
    for r, tree in enumerate(forest.trees):
        p = 1 / (1 + np.exp(-margin))
        plain = plain_tree(x, p - y, p * (1 - p), np.flatnonzero(~held), growth, edges)
        same(tree, 0, plain)
        margin += 0.4 * np.array([plain_value(plain, row) for row in x])
        assert forest.history[r] == pytest.approx(logloss(y[held], margin[held]), rel=1e-9)
    assert len(forest.trees) == 4 and np.allclose(forest.raw(x), margin)


def test_patience_keeps_the_best_round(spark):
    x, y = data(300, 2)
    df = frame(spark, x, y).withColumn("held", F.col("id") % 3 == 0)
    args = dict(validation="held", rate=1.0, growth=Growth(max_depth=5, min_child=0.1, reg_lambda=0.1), metric="logloss", bins=16)
    whole = ensembles.boost(df, NAMES, "y", rounds=7, **args)
    stopped = ensembles.boost(df, NAMES, "y", rounds=7, patience=2, **args)
    best = 0
    for r, v in enumerate(whole.history):
        best = r if v < whole.history[best] else best
        if r - best >= 2:
            break
    assert stopped.history == whole.history[:r + 1] and len(stopped.trees) == best + 1 < 7
    with pytest.raises(ValueError):
        ensembles.boost(df, NAMES, "y", patience=1)


@pytest.mark.parametrize("growth", [
    Growth("gini", max_depth=5, min_split=60, min_leaf=11, class_weight="balanced"),
    Growth("entropy", max_depth=None, min_split=100, class_weight=(1.0, 3.0), min_child=30.0),
    Growth("gini", max_depth=4, bootstrap=True, class_weight="balanced_subsample", min_leaf=5, seed=9),
    Growth("gini", max_depth=4, subsample=0.5, skip_fold=1, seed=5)])
def test_class_trees_equal_plain_version(spark, growth):
    x, y = data(1200, 3)
    edges = plain_edges(x)
    df = frame(spark, x, y).withColumn("fold", (F.col("id") % 3).cast("int"))
    table = trees.binned(df, NAMES, edges, "y", key="id", keep={"fold": "fold", "id": "id"})
    (tree,) = trees.grow(table, [growth], edges)
    keys = {r["id"]: r["key"] for r in table.select("id", "key").collect()}
    copies = growth.copies(np.array([keys[i] for i in range(len(y))], np.int64))
    if growth.skip_fold is not None:
        copies = np.where(np.arange(len(y)) % 3 == growth.skip_fold, 0, copies)
    rows = np.repeat(np.arange(len(y)), copies)
    assert growth.bootstrap is False or (0.55 < len(set(rows)) / len(y) < 0.7 and max(copies) > 2)
    weight = np.ones(len(y))
    if isinstance(growth.class_weight, str):
        ones = y[rows].sum()
        weight = np.where(y == 1, len(rows) / (2 * ones), len(rows) / (2 * (len(rows) - ones)))
    elif growth.class_weight:
        weight = np.where(y == 1, growth.class_weight[1], growth.class_weight[0])
    same(tree, 0, plain_tree(x, weight * (1 - y), weight * y, rows, growth, edges))


def test_balanced_subsample_differs_from_balanced(spark):
    x, y = data(800, 4)
    table = trees.binned(frame(spark, x, y), NAMES, plain_edges(x), "y", key="id")
    of = lambda mode: Growth("gini", max_depth=1, bootstrap=True, class_weight=mode, seed=3)
    counts, _ = trees.class_counts(table, [of("balanced"), of("balanced_subsample")])
    assert counts[0].sum() == 800 and counts[0][1] == y.sum() and not np.array_equal(counts[0], counts[1])


def test_trees_do_not_depend_on_partitions_or_groups(spark, monkeypatch):
    x, y = data(900, 5)
    edges = plain_edges(x)
    growths = [Growth("gini", max_depth=6, bootstrap=True, features="sqrt", seed=s) for s in range(3)] + [Growth("entropy", max_depth=3, colsample=0.5)]
    one = trees.grow(trees.binned(frame(spark, x, y, 1), NAMES, edges, "y", key="id"), growths, edges)
    monkeypatch.setattr(trees, "SCAN_BYTES", 20_000)
    seven = trees.grow(trees.binned(frame(spark, x, y, 7), NAMES, edges, "y", key="id"), growths, edges)
    for a, b in zip(one, seven):
        assert a.value == b.value or sorted(a.value) == sorted(b.value)
        assert np.allclose(np.array(a.value)[a.leaf_of(x)], np.array(b.value)[b.leaf_of(x)])
    assert len({tuple(t.feature) for t in one}) == 4


def test_depth_beyond_thirty(spark):
    n = 48
    x = np.arange(n, dtype=float)[:, None]
    y = np.arange(n) % 2
    rows = [(i, float(y[i]), float(i), 1.6 ** -i) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, y double, x0 double, w double")
    edges = [x[1:, 0].tolist()]
    table = trees.binned(df, ["x0"], edges, "y", "w")
    (tree,) = trees.grow(table, [Growth("gini", max_depth=None)], edges)
    assert max(tree.depth) > 30 and (np.array(tree.value)[tree.leaf_of(x)] == y)[:30].all()
    (tree,) = trees.grow(trees.binned(df, ["x0"], edges, "y"), [Growth("gini", max_depth=None)], edges)
    assert (np.array(tree.value)[tree.leaf_of(x)] == y).all()


def test_empty_and_single_class(spark):
    x, y = data(50, 6)
    df = frame(spark, x, y)
    for part in (df.where("false"), df.where("y = 1"), df.limit(1)):
        forest = ensembles.average(part, NAMES, "y", growths=[Growth("gini")])
        assert len(forest.trees) == 1 and forest.trees[0].left == [-1]
    assert len(ensembles.boost(df.where("false"), NAMES, "y", rounds=2).trees) == 2


def test_edges_are_distinct_quantiles(spark):
    x, y = data(700, 7)
    assert trees.quantile_edges(frame(spark, x, y), NAMES, 16) == plain_edges(x, 16)


def test_as_spark_classifiers(spark, tmp_path):
    x, y = data(900, 8, missing=0.0)
    df = frame(spark, x, y).withColumn("Class", F.col("y").cast("int"))
    train, val, test = (df.where(f"id % 4 {c}") for c in ("< 2", "= 2", "= 3"))
    for family, params, weights in (("gradient_boosting", {"n_estimators": 12, "max_depth": 3, "learning_rate": 0.5, "subsample": 0.9, "colsample": 0.8}, "auto"),
                                    ("histogram_forest", {"n_estimators": 8, "max_depth": 6, "class_weight": "balanced_subsample", "min_split": 10}, "none"),
                                    ("histogram_tree", {"max_depth": 4, "min_split": 20, "criterion": "entropy"}, "balanced")):
        spec = models.ModelSpec(family, params, NAMES, weights=weights)
        model = spec.fit(train, val if family == "gradient_boosting" else None, patience=3)
        path = str(tmp_path / family)
        models.save_model(model, path)
        scored = models.score_model(models.load_model(path), test, keep=["id"]).toPandas()
        again = models.score_model(model, test, keep=["id"]).toPandas()
        assert scored.sort_values("id")["score"].tolist() == again.sort_values("id")["score"].tolist()
        auc = (scored[scored.label == 1].score.to_numpy()[:, None] > scored[scored.label == 0].score.to_numpy()[None, :]).mean()
        assert auc > 0.65
        last = model.stages[-1]
        assert sum(r["importance"] for r in models.importances(model, spark).collect()) == pytest.approx(1.0)
        assert "x0 <" in models.tree_rules(model) and last.getNumTrees == len(last.forest.trees)
        assert ensembles.node_table(last.forest, spark).where("left < 0").agg(F.sum("rows")).first()[0] > 0
