import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rarelens.operators.trees import Growth
from rarelens.plans import ensembles
from rarelens.plans.attributions import tree_attributions

NAMES = [f"x{i}" for i in range(8)]


def made(spark, n=400, missing=0.15, seed=3):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 8)), 1)
    y = (x[:, 0] * x[:, 1] + x[:, 2] > 0.3).astype(float)
    x[rng.random(x.shape) < missing] = np.nan
    rows = [(i, float(y[i]), *[None if math.isnan(v) else float(v) for v in x[i]]) for i in range(n)]
    return x, spark.createDataFrame(rows, "row_id long, y double, " + ", ".join(f"{c} double" for c in NAMES))


def cover_score(tree, row, known, node=0):
    """Expected leaf value when only the features of `known` are known."""
    if tree.left[node] < 0:
        return tree.value[node]
    f, v = tree.feature[node], row[tree.feature[node]]
    children = tree.left[node], tree.right[node]
    if f in known:
        left = tree.missing_left[node] if math.isnan(v) else v < tree.threshold[node] or math.isinf(tree.threshold[node])
        return cover_score(tree, row, known, children[0 if left else 1])
    return sum(tree.cover[c] / tree.cover[node] * cover_score(tree, row, known, c) for c in children)


def enumerated(score, n=8):
    """Shapley values by all subsets of n features."""
    value = {s: score(frozenset(s)) for k in range(n + 1) for s in itertools.combinations(range(n), k)}
    out = []
    for f in range(n):
        total = 0.0
        for s, v in value.items():
            if f not in s:
                k = len(s)
                total += math.factorial(k) * math.factorial(n - k - 1) / math.factorial(n) * (value[tuple(sorted((*s, f)))] - v)
        out.append(total)
    return out, value[()]


def forests(df):
    boosted = ensembles.boost(df, NAMES, "y", rounds=2, rate=0.5, growth=Growth(max_depth=4, min_child=1.0), bins=16)
    averaged = ensembles.average(df, NAMES, "y", bins=16, growths=[
        Growth("gini", max_depth=5, bootstrap=True, features="sqrt", seed=s) for s in range(2)])
    return boosted, averaged


def gathered(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["row_id"], {})[r["feature"]] = (r["phi"], r["base"])
    return out


def test_equal_enumeration_of_subsets(spark):
    x, df = made(spark)
    for forest in forests(df):
        scale = forest.rate if forest.kind == "boosted" else 1 / len(forest.trees)
        raw = forest.raw(x)
        got = gathered(tree_attributions(df, forest, NAMES))
        assert len(got) == len(x)
        for i in range(0, 400, 57):
            want, _ = enumerated(lambda known: sum(scale * cover_score(t, x[i], known) for t in forest.trees))
            assert [got[i][c][0] for c in NAMES] == pytest.approx(want, abs=1e-9)
        for i, phi in got.items():
            assert sum(p for p, _ in phi.values()) + phi["x0"][1] == pytest.approx(raw[i], abs=1e-9)


def test_equal_enumeration_against_a_whole_background(spark):
    x, df = made(spark)
    back = x[:60]
    for forest in forests(df):
        got = gathered(tree_attributions(df.where("row_id % 50 = 7"), forest, NAMES, background=df.where("row_id < 60")))
        for i, phi in got.items():
            def score(known):
                mixed = back.copy()
                mixed[:, list(known)] = x[i, list(known)]
                return forest.raw(mixed).mean()
            want, base = enumerated(score)
            assert [phi[c][0] for c in NAMES] == pytest.approx(want, abs=1e-9) and phi["x0"][1] == pytest.approx(base)


def test_odd_tables(spark):
    x, df = made(spark, 80)
    forest = ensembles.boost(df, NAMES, "y", rounds=1, growth=Growth(max_depth=0))
    assert all(p == 0 for phi in gathered(tree_attributions(df, forest, NAMES)).values() for p, _ in phi.values())
    deep = ensembles.average(df, NAMES, "y", growths=[Growth("gini", max_depth=None)])
    assert tree_attributions(df.where("false"), deep, NAMES).count() == 0
    got = gathered(tree_attributions(df, deep, NAMES, background=df))
    raw = deep.raw(x)
    assert all(sum(p for p, _ in phi.values()) + phi["x0"][1] == pytest.approx(raw[i]) for i, phi in got.items())
    blank = df.limit(1).select("row_id", *[F.lit(None).cast("double").alias(c) for c in NAMES])
    assert len(gathered(tree_attributions(blank, deep, NAMES))) == 1
