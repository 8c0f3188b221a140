import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rarelens.operators import correlate, ingest, ordered, profile


@pytest.mark.parametrize("buckets", [None, 2])
@pytest.mark.parametrize("values", [
    [5.0], [1.0, 2.0], [3.0] * 50, [0.0] * 40 + list(range(60)), [random.Random(1).gauss(0, 1e6) for _ in range(777)]])
def test_quantiles_match_numpy(spark, values, buckets, monkeypatch):
    if buckets:
        monkeypatch.setattr(ordered, "bucket_count", lambda df: buckets)
    probs = [0.0, 0.01, 0.25, 0.5, 0.9, 0.99, 1.0]
    df = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(5)
    got = {r["prob"]: r["value"] for r in ordered.quantiles(df, ["x"], probs).collect()}
    for p in probs:
        assert got[p] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12)


def test_quantiles_skip_missing_and_keep_null_groups(spark):
    rows = [("a", 1.0), ("a", None), ("a", float("nan")), ("a", 3.0), (None, 7.0), ("b", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r["g"]: r["value"] for r in ordered.quantiles(df, ["x"], [0.5], ["g"]).collect()}
    assert got == {"a": 2.0, None: 7.0}


def test_quantiles_without_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(ordered, "BROADCAST_LINE_LIMIT", 0)
    pdf = pd.DataFrame({"g": [i % 7 for i in range(300)], "x": [float((i * 37) % 101) for i in range(300)]})
    got = {r["g"]: r["value"] for r in ordered.quantiles(spark.createDataFrame(pdf), ["x"], [0.3], ["g"]).collect()}
    want = pdf.groupby("g")["x"].quantile(0.3)
    assert got == pytest.approx(want.to_dict())


def test_average_ranks(spark):
    values = [3.0, 1.0, 3.0, 2.0, 3.0, 9.0, 1.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = {r["value"]: r["average_rank"] for r in ordered.distinct_ranks(df, ["x"]).collect()}
    want = dict(zip(values, pd.Series(values).rank()))
    assert got == want


def test_exact_sample_is_exact_and_stable(spark):
    df = spark.range(1000).withColumnRenamed("id", "row_id")
    ids = lambda n, seed: sorted(r[0] for r in ingest.sample_exact(df, ["row_id"], n, seed).collect())
    assert len(ids(137, 1)) == 137
    assert ids(137, 1) == ids(137, 1) != ids(137, 2)
    assert set(ids(50, 1)) < set(ids(137, 1))
    assert len(ids(5000, 1)) == 1000 and ids(0, 1) == []


def test_skew_split_join_keeps_every_row(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 900).alias("k"), "id")
    side = rows.groupBy("k").agg(F.count(F.lit(1)).alias("copies")).withColumn("total", F.lit(3000))
    out = ordered.skew_split_join(rows, side, ["k"], "copies", "total", share=100)
    assert out.count() == 3000 and out.select("id").distinct().count() == 3000


def test_profile_matches_pandas(spark):
    rng = np.random.default_rng(3)
    s = pd.Series(np.concatenate([rng.lognormal(3, 1.2, 800), [0.0] * 100]))
    r = profile.describe(spark.createDataFrame(pd.DataFrame({"x": s})), ["x"]).first()
    want = {"count": 900, "mean": s.mean(), "std": s.std(), "min": s.min(), "max": s.max(), "skew": s.skew(),
            "kurtosis": s.kurtosis(), "q01": s.quantile(.01), "q50": s.quantile(.5), "q99": s.quantile(.99)}
    for k, v in want.items():
        assert r[k] == pytest.approx(v, rel=1e-9)
    assert r["skew_label"] == "heavy right skew"


@pytest.mark.parametrize("values,skew,kurt", [([1.0], None, None), ([1.0, 2.0], None, None), ([2.0] * 5, 0.0, 0.0)])
def test_moments_of_tiny_inputs(spark, values, skew, kurt):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    r = df.agg(profile.sample_skewness("x").alias("s"), profile.sample_kurtosis("x").alias("k")).first()
    assert (r["s"], r["k"]) == (skew, kurt)


def test_constant_histogram_has_unit_range(spark):
    df = spark.createDataFrame([(4.0,)] * 7, "x double")
    rows = profile.histogram(df, "x", 4).orderBy("bin").collect()
    assert [r["count"] for r in rows] == [0, 0, 7, 0]
    assert rows[0]["left"] == 3.5 and rows[-1]["right"] == 4.5
    assert sum(r["density"] * (r["right"] - r["left"]) for r in rows) == pytest.approx(1.0)


def test_amount_profile_of_nothing_is_empty(spark):
    df = spark.createDataFrame([("x",), (None,), ("NaN",)], "Amount string")
    r = profile.amount_profile(df).first()
    assert r["empty"] and r["count"] == 0 and r["mean"] is None


def test_spearman_matches_pandas(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"row_id": range(300), "a": rng.integers(0, 9, 300).astype(float), "b": rng.random(300)})
    pdf["Class"] = (pdf["a"] + 4 * rng.random(300) > 6).astype(int)
    df = spark.createDataFrame(pdf)
    want = pdf[["a", "b", "Class"]].corr("spearman")
    for r in correlate.spearman_matrix(df, ["a", "b", "Class"], "row_id").collect():
        assert r["value"] == pytest.approx(want.loc[r["column_a"], r["column_b"]], abs=1e-9)
    for r in correlate.spearman_with_binary_target(df, ["a", "b"]).collect():
        assert r["correlation"] == pytest.approx(want.loc[r["feature"], "Class"], abs=1e-9)


def test_pearson_is_pairwise_complete(spark):
    pdf = pd.DataFrame({"a": [1.0, 2, 3, None, 5], "b": [2.0, 1, None, 4, 6], "c": [1.0, 0, 1, 0, 1]})
    want = pdf.corr()
    df = spark.createDataFrame([tuple(None if pd.isna(v) else v for v in r) for r in pdf.itertuples(index=False)],
                               "a double, b double, c double")
    for r in correlate.pearson_matrix(df, ["a", "b", "c"]).collect():
        assert r["value"] == pytest.approx(want.loc[r["column_a"], r["column_b"]])


def test_complete_columns_keep_their_precision(spark):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"a": 1e9 + rng.random(500), "b": rng.random(500), "c": [3.0] * 500})
    pdf["d"] = pdf["a"] - 1e9 + pdf["b"]
    df = spark.createDataFrame(pdf)
    for r in correlate.pearson_matrix(df, ["a", "b", "d"]).collect():
        assert r["value"] == pytest.approx(pdf[r["column_a"]].corr(pdf[r["column_b"]]), abs=1e-6)
    for r in correlate.covariance_matrix(df, ["a", "b"]).collect():
        assert r["value"] == pytest.approx(pdf[r["column_a"]].cov(pdf[r["column_b"]]), rel=1e-6, abs=1e-9)
    constant = {(r[0], r[1]): r[2] for r in correlate.pearson_matrix(df, ["a", "c"]).collect()}
    assert constant["a", "c"] is None


def test_mutual_information_ranks_the_informative_feature_first(spark):
    rng = np.random.default_rng(2)
    y = rng.integers(0, 2, 600)
    pdf = pd.DataFrame({"Class": y, "noise": rng.random(600), "signal": y + 0.1 * rng.random(600)})
    rows = correlate.binned_mutual_information(spark.createDataFrame(pdf), ["noise", "signal"]).collect()
    assert rows[0]["feature"] == "signal"
    assert rows[0]["mutual_information"] == pytest.approx(np.log(2), abs=0.05)


@pytest.mark.parametrize("groups", [1, 3])
def test_quantiles_of_groups_with_edges_from_a_sample(spark, monkeypatch, groups):
    """A table beyond the edge sample: rows are drawn, results are of all rows."""
    monkeypatch.setattr(ordered, "EDGE_SAMPLE", 100)
    monkeypatch.setattr(ordered, "bucket_count", lambda df: 4)
    monkeypatch.setattr(ordered, "estimated_rows", lambda df: 4000.0)
    pdf = pd.DataFrame({"g": [i % groups for i in range(4000)], "x": [float((i * 37) % 1009) for i in range(4000)], "z": [float(i) for i in range(4000)]})
    got = {(r["g"], r["column"], r["prob"]): r["value"] for r in ordered.quantiles(spark.createDataFrame(pdf), ["x", "z"], [0.1, 0.5], ["g"]).collect()}
    want = {(g, c, p): rows[c].quantile(p) for g, rows in pdf.groupby("g") for c in ("x", "z") for p in (0.1, 0.5)}
    assert got == pytest.approx(want)
    plan = ordered.range_buckets(spark.createDataFrame(pdf), ["x"], ["g"])
    assert plan.groups == groups and len(plan.edges["x"]) == 3
