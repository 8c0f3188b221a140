import numpy as np
import pytest
from pyspark.sql import functions as F

from rarelens.operators import trees
from rarelens.operators.splits import k_folds
from rarelens.operators.trees import Growth
from rarelens.plans import ensembles, search
from rarelens.plans.shared_search import shared_search
from tests.test_trees import NAMES, data, frame


def test_equals_separate_fits(spark, monkeypatch):
    x, y = data(600, 11, missing=0.05)
    df = frame(spark, x, y).withColumn("Class", F.col("y").cast("int"))
    candidates = [{"max_depth": 2}, {"criterion": "entropy", "max_depth": 4, "min_split": 30, "class_weight": "balanced"},
                  {"trees": 3, "max_depth": 3, "bootstrap": True, "features": "sqrt"}]
    scans = []
    scan = trees._scan
    monkeypatch.setattr(trees, "_scan", lambda *a: scans.append(1) or scan(*a))
    result = shared_search(df, NAMES, "Class", ["id"], candidates, 3, "aucpr", bins=16)
    assert len(scans) <= 4                                   # the deepest candidate's levels
    got = {(r["candidate"], r["fold"]): r["score"] for r in result.folds.collect()}
    folded = k_folds(df, "Class", ["id"], 3, "_fold")
    edges = trees.quantile_edges(folded, NAMES, 16)
    table = trees.binned(folded.withColumn("_key", F.xxhash64("id")), NAMES, edges, "Class", key="_key", keep={"fold": "_fold"})
    for c, p in enumerate(candidates):
        for f in range(3):
            own = {k: v for k, v in p.items() if k != "trees"}
            grown = trees.grow(table, [Growth(**{"criterion": "gini", "max_depth": None, **own, "skip_fold": f, "seed": 42 + 1000 * t}) for t in range(p.get("trees", 1))], edges)
            held = np.array([r["id"] for r in folded.where(f"_fold = {f}").select("id").collect()])
            scores = ensembles.Forest(grown, "averaged").raw(x[held])
            rows = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y[held], scores)], "label int, score double")
            assert got[c, f] == pytest.approx(search.average_precision(rows).first()[0], abs=1e-9)
    table = {r["candidate"]: r for r in result.table.collect()}
    assert all(table[c]["mean_test_score"] == pytest.approx(np.mean([got[c, f] for f in range(3)])) for c in range(3))
    assert result.best_score == max(r["mean_test_score"] for r in table.values()) and table[candidates.index(result.best_params)]["rank"] == 1


def test_odd_searches(spark):
    x, y = data(60, 12)
    df = frame(spark, x, y).withColumn("Class", F.col("y").cast("int"))
    with pytest.raises(ValueError):
        shared_search(df, NAMES, "Class", ["id"], [])
    with pytest.raises(ValueError):
        shared_search(df, NAMES, "Class", ["id"], [{}], metric="gini")
    found = shared_search(df.withColumn("Class", F.lit(0)), NAMES, "Class", ["id"], [{"max_depth": 1}], 2, "recall")
    assert found.best_score == 0.0


def test_trees_of_one_draw_share_sums(spark, monkeypatch):
    """Nodes that hold the same rows are added up once, and every tree is the one that it is alone."""
    x, y = data(400, 13, missing=0.05)
    df = frame(spark, x, y).withColumn("_fold", F.col("id") % 2)
    edges = trees.quantile_edges(df, NAMES, 16)
    table = trees.binned(df, NAMES, edges, "y", key="id", keep={"fold": "_fold"})
    growths = [Growth(c, max_depth=d, min_split=s, min_leaf=n, skip_fold=f, class_weight="balanced")
               for c in ("gini", "entropy") for d, s, n, f in ((2, 2, 1, 0), (3, 60, 20, 0), (3, 2, 1, 1))]
    growths += [Growth("gini", max_depth=2, bootstrap=True, features="sqrt", skip_fold=0, seed=s) for s in (1, 2)]
    asked = []
    scan = trees._scan
    monkeypatch.setattr(trees, "_scan", lambda *a: asked.append(len(a[3])) or scan(*a))
    together = trees.grow(table, growths, edges)
    assert asked[0] == 4                                     # two folds and two bootstraps, not eight trees
    for growth, tree in zip(growths, together, strict=True):
        assert tree == trees.grow(table, [growth], edges)[0]
