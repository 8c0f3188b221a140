import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rarelens.contracts import ContractError
from rarelens.operators import neighbors, resample, splits


def labelled(spark, n=1000, every=7):
    return spark.range(n).select(F.col("id").alias("row_id"), (F.col("id") % every == 0).cast("int").alias("Class"))


def test_published_split_sizes():
    counts = {0: 283_253, 1: 473}
    test = splits.held_out_counts(counts, 0.2)
    rest = {c: n - test[c] for c, n in counts.items()}
    val = splits.held_out_counts(rest, 0.1 / 0.8)
    assert (sum(test.values()), test[1]) == (56_746, 95)
    assert (sum(val.values()), val[1]) == (28_373, 47)
    assert sum(rest.values()) - sum(val.values()) == 198_607


@pytest.mark.parametrize("val_of", ["all", "rest"])
def test_three_way_counts_and_disjointness(spark, val_of):
    df = labelled(spark)
    out = splits.three_way_split(df, "Class", ["row_id"], 0.2, 0.1, val_of)
    got = {(r["split"], r["Class"]): r["count"] for r in out.groupBy("split", "Class").count().collect()}
    test = splits.held_out_counts({0: 857, 1: 143}, 0.2)
    assert got["test", 0] == test[0] and got["test", 1] == test[1]
    assert sum(v for (s, _), v in got.items() if s == "val") == (100 if val_of == "all" else 80)
    assert splits.split_overlap(out, ["row_id"]).first()[0] == 0
    again = splits.three_way_split(df.repartition(3), "Class", ["row_id"], 0.2, 0.1, val_of)
    assert out.exceptAll(again).count() == 0


def test_split_without_validation(spark):
    out = splits.three_way_split(labelled(spark, 50), "Class", ["row_id"], 0.2, 0.0)
    assert {r["split"] for r in out.select("split").distinct().collect()} == {"train", "test"}


def test_folds_are_balanced_in_every_class(spark):
    sizes = splits.k_folds(labelled(spark, 103), "Class", ["row_id"], 5).groupBy("Class", "fold").count().collect()
    for c in (0, 1):
        n = [r["count"] for r in sizes if r["Class"] == c]
        assert len(n) == 5 and max(n) - min(n) <= 1


def test_tiny_class_still_splits(spark):
    df = labelled(spark, 10, 10)  # one positive
    out = splits.k_folds(df, "Class", ["row_id"], 3)
    assert out.count() == 10 and out.where("Class = 1").count() == 1


def test_undersampling_keeps_the_minority_whole(spark):
    out = splits.undersample(labelled(spark), "Class", ["row_id"], 2.0)
    got = {r["Class"]: r["count"] for r in out.groupBy("Class").count().collect()}
    assert got == {0: 286, 1: 143}


def test_bad_labels_are_refused(spark):
    with pytest.raises(ContractError, match="NULL"):
        splits.class_counts(spark.createDataFrame([(None,), (1,)], "Class int"), "Class")
    with pytest.raises(ContractError, match="more than"):
        splits.class_counts(spark.range(2000), "id")


def brute_neighbours(ids, v, k):
    out = {}
    for i, a in zip(ids, v):
        d = [(((b - a) ** 2).sum(), j) for j, b in zip(ids, v) if j != i]
        out[i] = [j for _, j in sorted(d)[:k]]
    return out


@pytest.mark.parametrize("shape", ["random", "copies", "clusters", "grid"])
def test_neighbours_equal_brute_force(spark, shape):
    rng = np.random.default_rng(11)
    n, k = 240, 4
    v = rng.normal(size=(n, 3))
    if shape == "copies":  # a third of all rows share one vector
        v[::3] = v[0]
    elif shape == "clusters":
        v += np.repeat(rng.normal(scale=50, size=(6, 3)), n // 6, axis=0)
    elif shape == "grid":  # many exact distance ties
        v = np.array([[i % 6, i // 6 % 6, i // 36] for i in range(n)], dtype=float)
    ids = [int(i) for i in rng.permutation(n)]
    df = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in zip(ids, v)], "id long, v array<double>")
    # Blocks far smaller than the cells, so every path through cells, blocks and query splits is taken.
    got = neighbors.k_nearest(df, k, pivots=5, points_per_block=16, queries_per_block=32).collect()
    want = brute_neighbours(ids, v, k)
    found = {i: [r["neighbor"] for r in sorted((r for r in got if r["id"] == i), key=lambda r: r["rank"])] for i in ids}
    assert found == want
    where = dict(zip(ids, v))
    for r in got[:50]:
        assert r["distance"] == pytest.approx(float(np.linalg.norm(where[r["id"]] - where[r["neighbor"]])))
        assert r["neighbor_vector"] == [float(x) for x in where[r["neighbor"]]]


def test_neighbours_of_few_points(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, [3.0])], "id long, v array<double>")
    assert {(r["id"], r["neighbor"]) for r in neighbors.k_nearest(df, 5).collect()} == {(1, 2), (2, 1)}


def test_smote_counts_and_geometry(spark):
    rng = np.random.default_rng(4)
    rows = [(i, int(i < 30), *[float(x) for x in rng.normal(size=2)]) for i in range(1030)]
    df = spark.createDataFrame(rows, "row_id long, Class int, a double, b double")
    made = resample.smote(df, ["a", "b"], ratio=0.05).collect()
    assert len(made) == math.floor(0.05 * 1000) - 30
    minority = {r[0]: np.array(r[2:]) for r in rows if r[1] == 1}
    near = brute_neighbours(list(minority), np.array(list(minority.values())), 5)
    for r in made:
        assert r["Class"] == 1 and r["neighbor"] in near[r["base"]] and 0 <= r["gap"] < 1
        a, b = minority[r["base"]], minority[r["neighbor"]]
        assert np.allclose([r["a"], r["b"]], a + r["gap"] * (b - a))
    grown = resample.oversample(df, ["a", "b"], ratio=0.05)
    assert grown.where("Class = 1").count() == 50 and grown.where("Class = 0").count() == 1000
    with pytest.raises(ContractError):
        resample.smote(df, ["a", "b"], ratio=0.001)
