"""Inputs that the sample tables never hold: NULL, NaN, infinity, empty tables, text-like classes, exact gaps."""

import datetime as dt
import math

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rarelens.contracts import FeatureContract, ThresholdPolicy
from rarelens.functions.features import stable_hash
from rarelens.operators import ingest, ordered, profile, sweep
from rarelens.plans.scoring import LogisticScorer, score_rows
from rarelens.session import shared_dir
from rarelens.sources.tables import row_fingerprint
from rarelens.streaming import monitor


def test_rows_that_cannot_be_scored_get_no_label(spark):
    rows = spark.createDataFrame([(1, 0.0, "5"), (2, 0.0, None), (3, 0.0, "NaN"), (4, 0.0, "Infinity"), (5, -1.0, "5"), (6, 0.0, "x")],
                                 "row_id int, Time double, Amount string")
    model = LogisticScorer(inputCols=["Amount_log1p"], weights=[1.0], intercept=0.0)
    out = score_rows(rows, model, ThresholdPolicy("p", 0.5, "1", "linear"), FeatureContract(raw=("Time", "Amount"), version="t"), ["row_id"], reasons=True)
    got = {r["row_id"]: r for r in out.collect()}
    assert got[1]["predicted_label"] == "fraud" and got[1]["reasons"] == []
    for i in (2, 3, 4, 5, 6):
        assert got[i]["predicted_label"] is None and got[i]["fraud_probability"] is None and got[i]["reasons"]


def test_class_labels_are_ordered_by_value(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (0.0,), (10.0,), (2.0,)], "Class double")
    row = profile.class_balance(df).first()
    assert row["labels"] == ["0", "1", "2", "10"] and row["fraud_rate"] == 20.0
    text = spark.createDataFrame([("b",), ("a",), ("7",)], "Class string")
    assert profile.class_balance(text).first()["labels"] == ["7", "a", "b"]


def test_histograms_and_boxes_skip_nan_and_infinity(spark):
    df = spark.createDataFrame([(float(v), 0) for v in (1, 2, 3, 4)] + [(math.nan, 0), (math.inf, 0), (None, 0)], "v double, c int")
    assert [r["count"] for r in profile.histogram(df, "v", 3).orderBy("bin").collect()] == [1, 1, 2]
    box = profile.box_summary(df, "v", "c").first()
    assert box["count"] == 4 and box["outliers"] == 0


def test_fingerprints_keep_neighbouring_values_apart(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, ""), ("", None), ("", "")], "x string, y string")
    assert df.select(row_fingerprint("x", "y").alias("h")).distinct().count() == 5
    assert df.select(stable_hash("x").alias("h")).distinct().count() == 4


def test_sweep_of_nothing_has_zeros(spark):
    empty = spark.createDataFrame([], "label int, score double")
    row = sweep.sweep(empty, [0.5]).first()
    assert (row["tp"], row["fp"], row["tn"], row["fn"], row["recall"]) == (0, 0, 0, 0, 0.0)


def test_alert_rate_counts_unlabelled_rows(spark):
    at = dt.datetime(2024, 1, 1, 12)
    df = spark.createDataFrame([(at, 1, 0.9), (at, None, 0.8), (at, None, 0.1)], "ts timestamp, label int, score double")
    row = monitor.performance_windows(df, 0.5).first()
    assert abs(row["alert_rate"] - 2 / 3) < 1e-12 and (row["tp"], row["fp"], row["tn"], row["fn"]) == (1, 0, 0, 0)


def test_fractional_targets_are_rejected(spark):
    good = spark.createDataFrame([(1.0,), (0.0,), (None,)], "y double")
    assert [r["Class"] for r in ingest.binary_target(good, "y").collect()] == [1, 0, None]
    with pytest.raises(PySparkException):
        ingest.binary_target(spark.createDataFrame([(0.7,)], "y double"), "y").collect()


def test_a_pause_of_exactly_the_gap_stays_in_the_session(spark):
    start = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("a", start + dt.timedelta(minutes=m)) for m in (0, 10, 20, 31)] + [("b", None)], "k string, ts timestamp")
    got = monitor.sessions(df, "k", "10 minutes").orderBy("session_start").collect()
    assert [r["events"] for r in got] == [3, 1]


def test_edges_come_from_a_sample_and_results_stay_exact(spark, monkeypatch):
    df = spark.range(5000).select(((F.col("id") * 7919) % 1009 / 10).alias("v"))
    want = {r["prob"]: r["value"] for r in ordered.quantiles(df, ["v"], [0.0, 0.1, 0.5, 0.99, 1.0]).collect()}
    monkeypatch.setattr(ordered, "EDGE_SAMPLE", 50)
    monkeypatch.setattr(ordered, "estimated_rows", lambda _: 100_000.0)
    for buckets in (1, 7, 300):
        monkeypatch.setattr(ordered, "bucket_count", lambda _, n=buckets: n)
        assert {r["prob"]: r["value"] for r in ordered.quantiles(df, ["v"], [0.0, 0.1, 0.5, 0.99, 1.0]).collect()} == want


def test_clusters_must_name_a_shared_folder():
    class Jvm:
        def sc(self):
            return self

        def getCheckpointDir(self):
            return self

        def isDefined(self):
            return False

    class Context:
        _jsc, master = Jvm(), "spark://host:7077"

    class Conf:
        def get(self, name, default=None):
            return default

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())
