"""Monitoring: request windows, sessions, drift, performance over time, late labels, retrain triggers.

Every function takes a batch or a streaming table; the watermark only takes effect on a stream.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rarelens.functions.rates import Confusion, ratio
from rarelens.functions.sketch import log_bucket, sketch_quantile
from rarelens.operators.ordered import double_array, quantiles
from rarelens.session import ship_with_tasks

ship_with_tasks(__name__)

# Fixed values
DRIFT_FEATURES = ("Time", "Amount", "Hour", "hour_sin", "hour_cos", "Amount_log1p")
DRIFT_BINS = 10
SHARE_FLOOR = 1e-6
PSI_LIMIT = 0.2


def _window(ts: str, width: str, slide: str | None) -> Column:
    return F.window(ts, width, slide) if slide else F.window(ts, width)


def _watermarked(df: DataFrame, ts: str, delay: str) -> DataFrame:
    return df.withWatermark(ts, delay) if df.isStreaming else df


def request_windows(df: DataFrame, width: str = "1 hour", slide: str | None = None, delay: str = "1 hour",
                    ts: str = "ts", by: Sequence[str] = (), alert: Column | None = None,
                    failed: Column | None = None, latency: str | None = None, error: float = 0.01) -> DataFrame:
    """Counts and rates per window: requests, alerts, errors and p50/p95 latency within the relative `error`.

    Latencies are counted per logarithmic bucket first, and the buckets of a window are gathered then, both as plain
    aggregations: a stream holds a line per open window and bucket. Unknown latencies count as requests only.
    """
    alert = alert if alert is not None else F.lit(False)
    failed = failed if failed is not None else F.lit(False)
    aggs = [F.count(F.lit(1)).alias("requests"), F.count(F.when(alert, 1)).alias("alerts"),
            F.count(F.when(failed, 1)).alias("errors")]
    keys = [_window(ts, width, slide).alias("window"), *by]
    rows = _watermarked(df, ts, delay)
    if latency:
        counted = rows.groupBy(*keys, log_bucket(F.col(latency), error).alias("bucket")).agg(*aggs)
        line = F.when(F.col("bucket").isNotNull(), F.struct("bucket", F.col("requests").alias("n")))
        grouped = counted.groupBy("window", *by).agg(F.array_sort(F.collect_list(line)).alias("_latency"),
                                                     *[F.sum(c).alias(c) for c in ("requests", "alerts", "errors")])
    else:
        grouped = rows.groupBy(*keys).agg(*aggs)
    out = [F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *by,
           "requests", "alerts", "errors", ratio(F.col("alerts"), F.col("requests")).alias("alert_rate"),
           ratio(F.col("errors"), F.col("requests")).alias("error_rate")]
    if latency:
        out += [sketch_quantile(F.col("_latency"), p, error).alias(f"latency_p{p * 100:.0f}") for p in (0.5, 0.95)]
    return grouped.select(*out)


def sessions(df: DataFrame, key: str, gap: str = "30 minutes", delay: str = "1 hour", ts: str = "ts",
             amount: str | None = None) -> DataFrame:
    """Activity sessions per key, closed after a quiet gap.

    Rows of a key in one slot as wide as the gap always share a session. So a batch first adds up slots (combined before
    the shuffle, a hot key has one line per slot and task) and then joins slots that touch; a pause of exactly the gap
    does not end a session. A stream keeps one small state per open session.
    """
    def grouped(rows: DataFrame, window: Column, by: Sequence[str], aggs: Sequence[Column]) -> DataFrame:
        out = rows.groupBy(window.alias("_s"), *by).agg(*aggs)
        return out.withColumns({"session_start": F.col("_s.start"), "session_end": F.col("_s.end")}).drop("_s")

    first = [F.count(F.lit(1)).alias("events")] + ([F.sum(amount).alias("amount")] if amount else [])
    columns = [key, "session_start", "session_end", "events", *(["amount"] if amount else [])]
    if df.isStreaming:
        return grouped(_watermarked(df, ts, delay), F.session_window(ts, gap), [key], first).select(*columns)
    step = F.expr(f"unix_micros(timestamp_micros(0) + interval {gap})")
    slots = df.where(F.col(ts).isNotNull()).groupBy(key, F.floor(F.unix_micros(ts) / step).alias("_slot")).agg(
        F.min(ts).alias("session_start"), F.max(ts).alias("_last"), *first)
    parts = slots.withColumn("session_end", F.timestamp_micros(F.unix_micros("_last") + step))
    # A partial session already ends one gap after its last row, so its own length is the gap to the next.
    length = F.expr("make_interval(0, 0, 0, 0, 0, 0, (unix_micros(session_end) - unix_micros(session_start)) / 1000000BD)")
    again = [F.sum("events").alias("events")] + ([F.sum("amount").alias("amount")] if amount else [])
    return grouped(parts, F.session_window("session_start", length), [key], again).select(*columns)


# Drift -------------------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class DriftBaseline:
    """Quantile edges and bin shares of the training rows: a few numbers per feature."""

    edges: dict[str, list[float]]
    shares: dict[str, list[float]]

    @property
    def features(self) -> list[str]:
        return list(self.edges)


def _bin_counts(edges: Mapping[str, Sequence[float]]) -> list[Column]:
    """For each feature an array of its bin counts (value above e1, .., above the last edge, NULLs left out).

    One counter per edge; the bins are differences of neighbouring counters.
    """
    out = []
    for f, e in edges.items():
        above = [F.count(f), *[F.count(F.when(F.col(f) > F.lit(edge), 1)) for edge in e]]
        out.append(F.array(*[a - b for a, b in zip(above, [*above[1:], F.lit(0)])]).alias(f))
    return out


def fit_drift(train: DataFrame, features: Sequence[str] = DRIFT_FEATURES, bins: int = DRIFT_BINS) -> DriftBaseline:
    """Exact quantile edges (repeated ones merged) and the share of training rows in each bin."""
    inner = [i / bins for i in range(1, bins)]
    found: dict[str, set] = {f: set() for f in features}
    for r in quantiles(train, features, inner).collect():  # features x (bins-1) rows
        found[r["column"]].add(r["value"])
    edges = {f: sorted(v) for f, v in found.items()}
    row = train.agg(*_bin_counts(edges)).first()
    shares = {f: [c / max(sum(row[f]), 1) for c in row[f]] for f in features}
    return DriftBaseline(edges, shares)


def psi(live: DataFrame, baseline: DriftBaseline, by: Sequence[str] = ()) -> DataFrame:
    """by + (feature, rows, psi): one aggregation for all features and bins, no join."""
    counted = live.groupBy(*by).agg(*_bin_counts(baseline.edges))
    items = []
    for f in baseline.features:
        total = F.aggregate(F.col(f), F.lit(0).cast("bigint"), lambda a, x: a + x)
        floor = F.lit(SHARE_FLOOR)
        terms = F.zip_with(F.col(f), double_array(baseline.shares[f]), lambda c, e: F.struct(
            F.greatest(F.try_divide(c.cast("double"), F.when(total > 0, total)), floor).alias("a"),
            F.greatest(e, floor).alias("e")))
        value = F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + (t["a"] - t["e"]) * F.log(t["a"] / t["e"]))
        items.append(F.struct(F.lit(f).alias("feature"), total.alias("row_count"),
                              F.when(total > 0, value).alias("psi")))
    return counted.select(*by, F.explode(F.array(*items)).alias("_i")).select(*by, "_i.*")


def psi_windows(live: DataFrame, baseline: DriftBaseline, width: str = "1 day", delay: str = "1 hour",
                ts: str = "ts") -> DataFrame:
    """Drift of every feature in every window."""
    windowed = _watermarked(live, ts, delay).withColumn("window", F.window(ts, width))
    out = psi(windowed, baseline, ["window"])
    return out.select(F.col("window.start").alias("window_start"), "feature", "row_count", "psi")


# Performance -------------------------------------------------------------------------------------------------

def performance_windows(scored: DataFrame, threshold: float, width: str = "1 day", delay: str = "1 hour",
                        ts: str = "ts", label: str = "label", score: str = "score") -> DataFrame:
    """Confusion counts and rates of labelled scores per window; the alert rate is that of all scores."""
    said, true = F.col(score) >= F.lit(float(threshold)), F.col(label) == 1
    count = lambda c: F.count(F.when(c, 1))
    c = Confusion.of()
    grouped = _watermarked(scored, ts, delay).groupBy(F.window(ts, width).alias("window")).agg(
        count(said & true).alias("tp"), count(said & ~true).alias("fp"),
        count(~said & ~true).alias("tn"), count(~said & true).alias("fn"),
        count(said).alias("_alerts"), F.count(score).alias("_scored"))
    return grouped.select(
        F.col("window.start").alias("window_start"), "tp", "fp", "tn", "fn", c.precision.alias("precision"),
        c.recall.alias("recall"), c.f1.alias("f1"), c.f_beta(2.0).alias("f2"), ratio(F.col("_alerts"), F.col("_scored")).alias("alert_rate"))


def performance_drift(windows: DataFrame, baseline: Mapping[str, float]) -> DataFrame:
    """Each metric's change against its baseline value."""
    return windows.withColumns({f"{m}_change": F.col(m) - F.lit(float(v)) for m, v in baseline.items()})


@dataclass(frozen=True)
class RetrainLimits:
    psi: float = PSI_LIMIT
    min_precision: float = 0.80
    max_recall_drop: float = 0.05
    max_alert_rate_ratio: float = 2.0


def retrain_triggers(drift: DataFrame, performance: DataFrame, baseline: Mapping[str, float],
                     limits: RetrainLimits = RetrainLimits()) -> DataFrame:
    """(rule, subject, value, limit_value, fired) from drift and performance rows."""
    rows = lambda df, rule, subject, value, limit, fired: df.select(
        F.lit(rule).alias("rule"), subject.cast("string").alias("subject"), value.alias("value"),
        F.lit(float(limit)).alias("limit_value"), fired.alias("fired"))
    window = F.unix_seconds("window_start") if "window_start" in performance.columns else F.lit("all")
    p, r, a = F.col("precision"), F.col("recall"), F.col("alert_rate")
    floor = baseline["recall"] - limits.max_recall_drop
    ceiling = baseline["alert_rate"] * limits.max_alert_rate_ratio
    parts = [
        rows(drift, "psi_above_limit", F.col("feature"), F.col("psi"), limits.psi, F.col("psi") > limits.psi),
        rows(performance, "precision_below_target", window, p, limits.min_precision, p < limits.min_precision),
        rows(performance, "recall_degraded", window, r, floor, r < floor),
        rows(performance, "alert_rate_shift", window, a, ceiling, a > ceiling),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@dataclass(frozen=True)
class TriggerPolicy:
    """When a fired rule becomes a trigger: after `consecutive` fired windows in a row, then not for `cool_down` seconds.

    Windows are in a row if they start `width` seconds apart; a missing window breaks the row, as does one that did not fire.
    """

    consecutive: int = 2
    cool_down: int = 3 * 86_400
    width: int = 86_400


def _walk(windows: Sequence[tuple[int, bool, float]], policy: TriggerPolicy, state: tuple[int, int, int]) -> tuple[list[tuple], tuple[int, int, int]]:
    """Triggers (start, streak, value) of one rule's windows in order, from and to a state (last start, streak, last trigger)."""
    last, streak, triggered = state
    out = []
    for start, fired, value in sorted(windows):
        if start <= last:
            continue                                            # a window counts once
        streak = (streak + 1 if start - last == policy.width else 1) if fired else 0
        last = start
        if fired and streak >= policy.consecutive and start - triggered >= policy.cool_down:
            out.append((start, streak, value))
            triggered = start
    return out, (last, streak, triggered)


_NEVER = -(2 ** 62)


def triggers(rules: DataFrame, policy: TriggerPolicy = TriggerPolicy()) -> DataFrame:
    """(rule, subject, window_start, streak, value) from rows (rule, subject, window_start, value, fired) of closed windows.

    `window_start` is in seconds. A stream keeps three numbers per rule and subject, for as long as a row of windows or a
    cool-down can last: a timer forgets them once no window has come for that long. A batch walks each rule's windows, whose
    number is that of the windows in the table's time span. A NULL `fired` is a window that did not fire. A stream needs a column
    `ts` with a watermark, and, as Spark allows no such state behind an aggregation, windows that were written (`jobs.stage`).
    """
    schema = "rule string, subject string, window_start long, streak int, value double"
    rows = rules.select("rule", "subject", F.col("window_start").cast("long").alias("window_start"), F.col("value").cast("double").alias("value"),
                        F.coalesce("fired", F.lit(False)).alias("fired"), *(["ts"] if rules.isStreaming else []))

    def lines(key, found) -> pd.DataFrame:
        return pd.DataFrame([(*key, *f) for f in found], columns=["rule", "subject", "window_start", "streak", "value"])

    def parts(pdf: pd.DataFrame) -> list[tuple[int, bool, float]]:
        return [(int(s), bool(f), float(v)) for s, f, v in zip(pdf["window_start"], pdf["fired"], pdf["value"], strict=True)]

    if not rules.isStreaming:
        def whole(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            return lines(key, _walk(parts(pdf), policy, (_NEVER, 0, _NEVER))[0])
        return rows.groupBy("rule", "subject").applyInPandas(whole, schema)

    def step(key, pdfs: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        windows = [w for pdf in pdfs for w in parts(pdf)]
        found, after = _walk(windows, policy, state.get if state.exists else (_NEVER, 0, _NEVER))
        state.update(after)
        # nothing later can depend on this state any more
        forget = (after[0] + max(policy.cool_down, 2 * policy.width)) * 1000
        state.setTimeoutTimestamp(max(forget, state.getCurrentWatermarkMs() + 1))
        if found:
            yield lines(key, found)

    return rows.groupBy("rule", "subject").applyInPandasWithState(step, schema, "last long, streak long, triggered long", "append", "EventTimeTimeout")


# Late labels -------------------------------------------------------------------------------------------------

def join_late_labels(scores: DataFrame, labels: DataFrame, key: str = "row_id", horizon: str = "7 days",
                     delay: str = "1 hour", score_ts: str = "ts", label_ts: str = "label_ts") -> DataFrame:
    """Scores with the label that arrives within `horizon`; unmatched scores come out once it has passed.

    `labels` carries the key, its event time and the label columns. Both sides are watermarked, so a stream
    holds rows for the horizon and no longer.
    """
    left = _watermarked(scores, score_ts, delay)
    right = _watermarked(labels.withColumnRenamed(key, "_label_key"), label_ts, delay)
    on_time = ((F.col(key) == F.col("_label_key")) & (F.col(label_ts) >= F.col(score_ts))
               & (F.col(label_ts) <= F.col(score_ts) + F.expr(f"INTERVAL {horizon}")))
    return left.join(right, on_time, "left_outer").drop("_label_key")


def drop_repeats(df: DataFrame, key: str = "row_id", delay: str = "1 hour", ts: str = "ts") -> DataFrame:
    """At most one row per key; a stream forgets keys once the watermark has passed them."""
    if df.isStreaming:
        return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])
    return df.dropDuplicates([key])
