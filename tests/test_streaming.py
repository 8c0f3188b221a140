import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rarelens.streaming import jobs, monitor

T0 = dt.datetime(2024, 1, 1)


def write_batches(spark, tmp_path, batches, schema):
    """One file per batch, in order."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / f"in/b{i}"))
    return (spark.readStream.schema(schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1)
            .parquet(str(tmp_path / "in")))


def at(hours):
    return T0 + dt.timedelta(hours=hours)


def test_stream_windows_equal_batch_windows(spark, small):
    batch = monitor.request_windows(jobs.event_time(spark.read.parquet(f"{small}/events.parquet")), "1 day",
                                    alert=F.col("value") > 50)
    stream = monitor.request_windows(jobs.stream_events(spark, small), "1 day", alert=F.col("value") > 50)
    closed = {r["window_start"]: r for r in jobs.run_available(stream, "test-windows").collect()}
    whole = {r["window_start"]: r for r in batch.collect()}
    assert len(closed) >= 28 and all(whole[k] == v for k, v in closed.items())


def test_events_behind_the_watermark_are_late(spark, tmp_path):
    schema = "ts timestamp, value double"
    # A batch drops rows behind the watermark that held before it, which the first two files have set.
    stream = write_batches(spark, tmp_path, [[(at(0.5), 1.0), (at(10), 1.0)], [(at(20), 1.0)],
                                             [(at(0.6), 1.0), (at(40), 1.0)], [(at(60), 1.0)]], schema)
    out = jobs.run_available(monitor.request_windows(stream, "1 hour", delay="1 hour"), "test-late").collect()
    assert {r["window_start"]: r["requests"] for r in out} == {at(0): 1, at(10): 1, at(20): 1, at(40): 1}


def test_repeats_are_dropped_within_the_watermark(spark, tmp_path):
    schema = "row_id long, ts timestamp"
    stream = write_batches(spark, tmp_path, [[(1, at(0)), (2, at(0))], [(1, at(0.2)), (3, at(0.5))]], schema)
    out = jobs.run_available(monitor.drop_repeats(stream), "test-repeats").collect()
    assert sorted(r["row_id"] for r in out) == [1, 2, 3]


def test_unlabelled_scores_come_out_after_the_horizon(spark, tmp_path):
    scores = write_batches(spark, tmp_path / "s", [[(1, at(0)), (2, at(1))], [(3, at(24 * 30))]], "row_id long, ts timestamp")
    labels = write_batches(spark, tmp_path / "l", [[(1, at(24), 1)], [(9, at(24 * 30), 0)]],
                           "row_id long, label_ts timestamp, label int")
    out = jobs.run_available(monitor.join_late_labels(scores, labels), "test-labels").collect()
    assert {r["row_id"]: r["label"] for r in out} == {1: 1, 2: None}


def test_sessions_across_days_equal_a_plain_walk(spark):
    rng = np.random.default_rng(6)
    rows = [(int(rng.integers(0, 3)) if i % 3 else 7, T0 + dt.timedelta(seconds=int(s)), 1.0)
            for i, s in enumerate(rng.integers(0, 4 * 86400, 500))]
    got = sorted((r["user_id"], r["session_start"], r["session_end"], r["events"], r["amount"]) for r in monitor.sessions(
        spark.createDataFrame(rows, "user_id long, ts timestamp, amount double"), "user_id", "40 minutes", amount="amount").collect())
    want, gap = [], dt.timedelta(minutes=40)
    for user in sorted({r[0] for r in rows}):
        for t in sorted(r[1] for r in rows if r[0] == user):
            if want and want[-1][0] == user and t <= want[-1][2]:
                want[-1] = (user, want[-1][1], t + gap, want[-1][3] + 1, want[-1][4] + 1.0)
            else:
                want.append((user, t, t + gap, 1, 1.0))
    assert got == want


def test_late_label_join_in_batch_respects_the_horizon(spark):
    scores = spark.createDataFrame([(1, at(0)), (2, at(0))], "row_id long, ts timestamp")
    labels = spark.createDataFrame([(1, at(24 * 6), 1), (2, at(24 * 8), 1)], "row_id long, label_ts timestamp, label int")
    got = {r["row_id"]: r["label"] for r in monitor.join_late_labels(scores, labels).collect()}
    assert got == {1: 1, 2: None}


def test_psi_matches_its_definition(spark):
    rng = np.random.default_rng(0)
    base, live = rng.normal(size=4000), rng.normal(0.4, 1.3, size=3000)
    df = lambda v: spark.createDataFrame([(float(x),) for x in v], "x double")
    fitted = monitor.fit_drift(df(base), ["x"])
    edges = np.quantile(base, np.arange(1, 10) / 10)
    share = lambda v: np.bincount(np.searchsorted(edges, v, side="left"), minlength=10) / len(v)
    e, a = share(base), share(live)
    want = float(((a - e) * np.log(a / e)).sum())
    assert monitor.psi(df(live), fitted).first()["psi"] == pytest.approx(want, rel=1e-9)
    assert monitor.psi(df(base), fitted).first()["psi"] == pytest.approx(0.0, abs=1e-12)


def test_psi_of_empty_and_constant_features(spark):
    df = spark.createDataFrame([(1.0, None), (1.0, 2.0)], "x double, y double")
    fitted = monitor.fit_drift(df, ["x", "y"])
    assert fitted.edges["x"] == [1.0]
    rows = {r["feature"]: r for r in monitor.psi(df.where("y IS NULL"), fitted).collect()}
    assert rows["x"]["psi"] == pytest.approx(0.0) and rows["y"]["psi"] is None


def test_triggers_fire_on_their_limits(spark):
    drift = spark.createDataFrame([("Amount", 0.3), ("Hour", 0.1)], "feature string, psi double")
    perf = spark.createDataFrame([(at(0), 0.7, 0.9, 0.02), (at(24), 0.85, 0.5, 0.30)],
                                 "window_start timestamp, precision double, recall double, alert_rate double")
    out = monitor.retrain_triggers(drift, perf, {"recall": 0.8, "alert_rate": 0.1})
    fired = sorted((r["rule"], r["value"]) for r in out.where("fired").collect())
    assert fired == [("alert_rate_shift", 0.30), ("precision_below_target", 0.7), ("psi_above_limit", 0.3), ("recall_degraded", 0.5)]


def test_latency_sketch_is_within_its_error(spark, small):
    e = jobs.event_time(spark.read.parquet(f"{small}/events.parquet"))
    r = monitor.request_windows(e, "365 days", latency="value").first()
    values = np.sort([x["value"] for x in e.select("value").collect()])
    for field, q in (("latency_p50", 0.5), ("latency_p95", 0.95)):
        rank = np.searchsorted(values, r[field], side="right") / len(values)
        assert math.isclose(rank, q, abs_tol=0.01)


def test_continuous_run_restarts_from_its_state(spark, tmp_path, small):
    stream = lambda: jobs.stream_events(spark, small).select("event_id", "value")
    for _ in range(2):
        run = jobs.start_continuous(stream(), str(tmp_path / "out"), "1 second")
        try:
            run.processAllAvailable()
        finally:
            run.stop()
    assert spark.read.parquet(str(tmp_path / "out/table")).count() == spark.read.parquet(f"{small}/events.parquet").count()


def test_latency_buckets_merge_and_bound_the_error(spark):
    from rarelens.functions.sketch import log_bucket, sketch_quantile
    rng = np.random.default_rng(8)
    values = [float(v) for v in np.exp(rng.normal(2, 2, 900))] + [0.0, -3.0, 1e-9] + [7.0] * 400
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "x double").repartition(5)
    for error in (0.01, 0.1):
        counted = df.groupBy(log_bucket(F.col("x"), error).alias("bucket")).agg(F.count("*").alias("n")).where("bucket is not null")
        lines = counted.agg(F.array_sort(F.collect_list(F.struct("bucket", "n"))).alias("b"))
        shares = (0.0, 0.25, 0.5, 0.95, 1.0)
        row = lines.select(*[sketch_quantile(F.col("b"), q, error).alias(f"q{i}") for i, q in enumerate(shares)]).first()
        for i, q in enumerate(shares):
            exact = max(sorted(values)[math.floor(q * (len(values) - 1))], 0.0)
            assert row[f"q{i}"] == pytest.approx(exact, rel=error * 1.0001, abs=1e-12)
    empty = spark.range(1).select(sketch_quantile(F.array().cast("array<struct<bucket:int,n:long>>"), 0.5, 0.01).alias("q")).first()
    assert empty["q"] is None
    with pytest.raises(ValueError):
        log_bucket(F.col("x"), 1.0)


def test_latency_windows_of_a_stream_equal_the_batch(spark, small):
    def windows(df):
        return monitor.request_windows(df, "1 day", by=["event_type"], latency="value", failed=F.col("event_type") == "error")
    batch = {(r["window_start"], r["event_type"]): r for r in windows(jobs.event_time(spark.read.parquet(f"{small}/events.parquet"))).collect()}
    closed = jobs.run_available(windows(jobs.stream_events(spark, small)), "test-latency").collect()
    assert len(closed) > 50 and all(batch[r["window_start"], r["event_type"]] == r for r in closed)


def plain_triggers(rows, policy):
    out = []
    for subject in {r[0] for r in rows}:
        streak, before, triggered = 0, None, None
        for _, start, value, fired in sorted({r for r in rows if r[0] == subject}, key=lambda r: r[1]):
            streak = 0 if not fired else streak + 1 if before is not None and start - before == policy.width else 1
            before = start
            if fired and streak >= policy.consecutive and (triggered is None or start - triggered >= policy.cool_down):
                out.append((subject, start, streak, value))
                triggered = start
    return sorted(out)


def rule_rows(n, seed):
    rng = np.random.default_rng(seed)
    return [(s, int(d) * 86_400, float(rng.random()), [True, True, False, None][rng.integers(0, 4)]) for s in ("a", "b", "c") for d in range(n) if rng.random() > 0.1]


@pytest.mark.parametrize("consecutive,pause", [(1, 0), (2, 3), (3, 10)])
def test_triggers_equal_a_plain_walk(spark, tmp_path, consecutive, pause):
    policy = monitor.TriggerPolicy(consecutive, pause * 86_400)
    rows = rule_rows(60, consecutive)
    schema = "subject string, window_start long, value double, fired boolean"
    shown = lambda df: sorted((r["subject"], r["window_start"], r["streak"], r["value"]) for r in df.collect())
    batch = monitor.triggers(spark.createDataFrame(rows, schema).withColumn("rule", F.lit("r")), policy)
    assert shown(batch) == plain_triggers(rows, policy) and shown(batch)
    if consecutive != 2:
        return
    # in files of a few days each, with windows that come again
    parts = [[r for r in rows if 8 * i <= r[1] // 86_400 < 8 * i + 8] for i in range(8)]
    parts[3] = parts[3] + parts[2][:4]
    stream = write_batches(spark, tmp_path, [p for p in parts if p], schema).withColumn("rule", F.lit("r"))
    stream = stream.withColumn("ts", F.timestamp_seconds(F.col("window_start") + 86_399)).withWatermark("ts", "0 seconds")
    assert shown(jobs.run_available(monitor.triggers(stream, policy), "test-triggers")) == plain_triggers(rows, policy)


def test_triggers_of_no_rows(spark):
    empty = spark.createDataFrame([], "rule string, subject string, window_start long, value double, fired boolean")
    assert monitor.triggers(empty).count() == 0
