import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rarelens.llm import hard_negatives
from rarelens.llm.catalog import QUERIES, SQL
from tests.compare import connect, difference

SCHEMA = "vec_id long, embedding array<double>, label int, id string, dim string, grp int, v string, uid int"


def brute(rows, every, k=5, low=80, high=100):
    usable = []
    for i, v, label in rows:
        if i is None or label is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole = [math.floor(256 * x) for x in v]
        if sum(x * x for x in whole) <= 2 ** 62:
            usable.append((i, whole, label))
    out = []
    for i, v, label in usable:
        if i % every:
            continue
        near = [(-sum(x * y for x, y in zip(v, w)), j, other) for j, w, other in usable if j != i and len(v) == len(w)]
        for s, j, _ in sorted(n for n in near if n[2] == label)[:k]:
            fits = sorted(n for n in near if n[2] != label and low * -s <= 100 * -n[0] <= high * -s)
            out += [(i, j, r, m[1], -s, -m[0]) for r, m in enumerate(fits[:k], 1)]
    return sorted(out)


def run(spark, rows, every):
    df = spark.createDataFrame([(*r, "x", "y", 1, "z", 2) for r in rows], SCHEMA)
    return sorted(tuple(r) for r in hard_negatives.mine(df, F.col("id") % every == 0).collect())


def made(n, dims, labels, scale, seed):
    rng = random.Random(seed)
    # few values, so that scores tie
    return [(i, [rng.randint(-3, 5) * scale for _ in range(dims)], rng.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize("scale", [0.01, 1.0, 2.0 ** 15, 2.0 ** 19])
def test_equals_brute_force(spark, monkeypatch, scale):
    monkeypatch.setattr(hard_negatives, "GROUP", 7)
    monkeypatch.setattr(hard_negatives, "BLOCK", (20, 50))
    monkeypatch.setattr(hard_negatives, "CHUNK", (3, 16))
    rows = made(160, 6, 3, scale, 1)
    got = run(spark, rows, 10)
    assert got == brute(rows, 10) and got


def test_odd_rows(spark):
    rows = made(90, 3, 2, 0.1, 2) + made(30, 5, 2, 0.3, 3)[:25]
    rows += [rows[10], rows[10], rows[7], (20, [0.0, 0.0, 0.0], 1), (None, [1.0, 1.0, 1.0], 1), (1000, None, 0), (1010, [], 0), (1020, [1.0, None, 1.0], 0),
             (1030, [1.0, float("nan"), 1.0], 1), (1040, [float("inf"), 0.0, 0.0], 1), (1050, [0.5, 0.5, 0.5], None), (1060, [1e300, 0.0, 0.0], 1),
             (1070, [1.0] * 9, 1), (-10, [0.1, -0.2, 0.3], 77)]
    assert run(spark, rows, 10) == brute(rows, 10)
    assert run(spark, [], 10) == [] and run(spark, [(1, [0.5], 1), (2, [0.5], 1)], 10) == []


def test_a_hot_vector(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK", (50, 100))
    rows = made(60, 4, 3, 0.2, 4) + [(100 + i, [0.4, 0.2, 0.4, 0.2], i % 2) for i in range(200)]
    assert run(spark, rows, 20) == brute(rows, 20)


@pytest.mark.parametrize("size", [1, 200, 2 ** 12, 2 ** 30])
def test_products_are_exact(size):
    rng = np.random.default_rng(size)
    for shape in ((1, 1, 1), (4, 13, 3), (9, 64, 17)):
        a, c = rng.integers(-size, size + 1, (shape[0], shape[2])), rng.integers(-size, size + 1, (shape[1], shape[2]))
        if shape[2] * size ** 2 < 2 ** 62:
            assert (hard_negatives.Packed(a).scores(c) == a.astype(object) @ c.T.astype(object)).all()


def test_several_candidates_share_a_product():
    """Components like those of the given vectors: two candidates in each double."""
    rng = np.random.default_rng(5)
    shapes = []

    class Watched(np.ndarray):
        def __matmul__(self, other):
            shapes.append(other.shape)
            return np.asarray(self) @ other

    packed = hard_negatives.Packed(rng.integers(-150, 150, (3, 64)))

    class Moved(np.ndarray):
        def astype(self, kind):
            return np.asarray(self).astype(kind).view(Watched)

    packed.moved = packed.moved.view(Moved)
    packed.scores(rng.integers(-150, 150, (100, 64)))
    assert shapes == [(64, 50)]


def test_query_equals_sql(spark, small):
    problem, _ = difference(spark, QUERIES["op12_hard_negatives"], SQL["op12_hard_negatives"], connect(small), small)
    assert problem is None
