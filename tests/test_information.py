import numpy as np
import pytest

from rarelens.operators import ordered
from rarelens.operators.information import digamma, neighbor_mutual_information

EULER = 0.5772156649015329


def psi(n):
    return -EULER + sum(1 / i for i in range(1, int(n)))


def plain(values, y, k=3):
    """The estimate by direct search."""
    values = np.nan_to_num(np.array([0.0 if v is None else v for v in values], float))
    keep = [i for i, c in enumerate(y) if c is not None and list(y).count(c) > 1]
    total = psi(len(keep))
    for i in keep:
        own = sorted(abs(values[j] - values[i]) for j in keep if j != i and y[j] == y[i])
        kc = min(k, len(own))
        r = own[kc - 1]
        m = sum(abs(values[j] - values[i]) < r or values[j] == values[i] for j in keep)
        total += (psi(kc) - psi(len(own) + 1) - psi(m)) / len(keep)
    return max(total, 0.0)


@pytest.mark.parametrize("buckets", [None, 3, 40])
def test_equals_direct_search(spark, monkeypatch, buckets):
    if buckets:
        monkeypatch.setattr(ordered, "bucket_count", lambda df: buckets)
    rng = np.random.default_rng(5)
    y = [None if u < 0.03 else ["a", "b", "b", "c"][int(u * 4) % 4] for u in rng.random(300)] + ["lonely"]
    smooth = [float(v + (c == "a")) for v, c in zip(rng.normal(size=301), y)]
    ties = [float(rng.integers(0, 6)) / 10 + 0.1 * (c == "c") for c in y]
    hot = [0.0 if rng.random() < 0.5 else float(rng.normal()) for _ in y]
    gaps = [None if rng.random() < 0.1 else float("nan") if rng.random() < 0.1 else float(rng.normal()) for _ in y]
    rows = list(zip(y, smooth, ties, hot, gaps))
    df = spark.createDataFrame(rows, "y string, smooth double, ties double, hot double, gaps double")
    got = {r[0]: r[1] for r in neighbor_mutual_information(df, ["smooth", "ties", "hot", "gaps"], "y").collect()}
    for i, name in enumerate(["smooth", "ties", "hot", "gaps"], start=1):
        assert got[name] == pytest.approx(plain([r[i] for r in rows], y), abs=1e-9)


def test_small_and_empty(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 2.0), (1, 5.0), (1, 5.0), (1, 9.0), (2, 0.0)], "y int, x double")
    assert neighbor_mutual_information(df, ["x"], "y").first()[1] == pytest.approx(plain([1.0, 2, 5, 5, 9, 0], [0, 0, 1, 1, 1, 2]))
    assert neighbor_mutual_information(df.where("false"), ["x"], "y").count() == 0
    assert neighbor_mutual_information(df, ["x"], "y", top=1).count() == 1


def test_digamma(spark):
    row = spark.range(1).select(*[digamma(spark_lit(n)).alias(f"p{n}") for n in (1, 2, 7, 100)]).first()
    assert [row[f"p{n}"] for n in (1, 2, 7, 100)] == pytest.approx([psi(n) for n in (1, 2, 7, 100)], abs=1e-11)


def spark_lit(n):
    from pyspark.sql import functions as F
    return F.lit(float(n))
