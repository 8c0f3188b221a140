"""Scoring, validation, streaming and monitoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from rarelens.catalog.profiling import FAULTY, faulty, tx, txh
from rarelens.catalog.registry import TX, TXH, query, rounded
from rarelens.contracts import FeatureContract, ThresholdPolicy
from rarelens.plans import scoring
from rarelens.plans.scoring import LogisticScorer
from rarelens.sources import configs, tables
from rarelens.streaming import jobs, monitor

CONTRACT = FeatureContract(raw=("Time", "Amount"), version="sample")
POLICY = ThresholdPolicy("locked_sample", 0.5, "1", "linear")
MODEL = LogisticScorer(inputCols=["Amount_log1p", "hour_sin", "hour_cos"], weights=[0.9, 0.7, -0.4], intercept=-3.2)
P = "(1.0::DOUBLE / (1.0::DOUBLE + exp(-(-3.2::DOUBLE + 0.9::DOUBLE * \"Amount_log1p\" + 0.7::DOUBLE * hour_sin + -0.4::DOUBLE * hour_cos))))"
SCORED = TXH + f", sco AS (SELECT *, {P} AS p FROM txh)"
EPOCH = "epoch_us(ts) // 1000000"

SCORE_COLUMNS = f"""'1' AS model_version, 'locked_sample' AS threshold_policy, 0.5::DOUBLE AS threshold_used, round(p, 6) AS fraud_probability,
CASE WHEN p >= 0.5 THEN 'fraud' ELSE 'legit' END AS predicted_label"""


@query("score_batch", f"WITH {SCORED} SELECT row_id, {SCORE_COLUMNS} FROM sco")
def score_batch(spark, d):
    return rounded(scoring.score_rows(tx(spark, d), MODEL, POLICY, CONTRACT, ["row_id"]))


@query("score_by_id", f"""WITH {SCORED}, ids AS (SELECT DISTINCT o_custkey * 11 AS row_id FROM orders)
SELECT ids.row_id, CASE WHEN sco.row_id IS NULL THEN 'not_found' ELSE 'found' END AS status, "Class" AS true_label,
CASE WHEN p IS NULL THEN NULL ELSE '1' END AS model_version, CASE WHEN p IS NULL THEN NULL ELSE 'locked_sample' END AS threshold_policy,
CASE WHEN p IS NULL THEN NULL ELSE 0.5::DOUBLE END AS threshold_used, round(p, 6) AS fraud_probability,
CASE WHEN p >= 0.5 THEN 'fraud' WHEN p IS NOT NULL THEN 'legit' END AS predicted_label FROM ids LEFT JOIN sco USING (row_id)""")
def score_by_id(spark, d):
    ids = tables.sample_table(spark, d, "orders").select((F.col("o_custkey") * 11).alias("row_id")).distinct()
    return rounded(scoring.score_by_id(tx(spark, d), ids, MODEL, POLICY, CONTRACT))


@query("serving_metadata", f"""WITH {TX} SELECT '1' AS model_version, 'locked_sample' AS threshold_policy, 0.5::DOUBLE AS threshold_used,
6::BIGINT AS n_features, count(*) AS rows_served FROM tx""")
def serving_metadata(spark, d):
    meta = {"model_version": "1", "git_commit": "none", "train_date": "2024-01-30"}
    view = configs.serving_view(spark, POLICY, CONTRACT, meta)
    served = tx(spark, d).agg(F.count(F.lit(1))).scalar()
    return view.select("model_version", "threshold_policy", "threshold_used",
                       F.size("model_features").cast("bigint").alias("n_features"), served.alias("rows_served"))


# Payloads built from the events: fields go missing, extra ones appear, values turn bad.
def payloads(spark, d):
    f = faulty(spark, d)
    fields = F.when(F.col("row_id") % 29 == 0, F.to_json(F.struct("Time"))) \
        .when(F.col("row_id") % 31 == 0, F.to_json(F.struct("Time", F.col("raw").alias("Amount"), F.lit("x").alias("note")))) \
        .when(F.col("row_id") % 37 == 0, F.lit("not json")) \
        .otherwise(F.to_json(F.struct("Time", F.coalesce("raw", F.lit("-5")).alias("Amount"))))
    return f.select("row_id", fields.alias("payload"))


REASON = """CASE WHEN row_id % 29 = 0 THEN 'missing field: Amount'
  WHEN row_id % 31 = 0 AND raw IS NULL THEN 'missing field: Amount; unexpected field: note' WHEN row_id % 31 = 0 THEN 'unexpected field: note'
  WHEN row_id % 37 = 0 THEN 'payload is not a JSON object' WHEN raw IS NULL THEN 'Amount: negative'
  WHEN raw = 'n/a' THEN 'Amount: not numeric' WHEN raw = 'NaN' THEN 'Amount: NaN' WHEN raw = 'Infinity' THEN 'Amount: infinite' ELSE '' END"""


@query("payload_validation", f"WITH {FAULTY} SELECT row_id, {REASON} AS reasons FROM faulty")
def payload_validation(spark, d):
    return scoring.parse_payloads(payloads(spark, d), CONTRACT).select(
        "row_id", F.array_join("reasons", "; ").alias("reasons"))


@query("quarantine", f"""WITH {FAULTY} SELECT CASE WHEN raw IS NULL THEN 'Amount: missing' WHEN raw = 'n/a' THEN 'Amount: not numeric'
WHEN raw = 'NaN' THEN 'Amount: NaN' ELSE 'Amount: infinite' END AS reasons, count(*) AS n FROM faulty
WHERE raw IS NULL OR raw IN ('n/a', 'NaN', 'Infinity') GROUP BY 1""")
def quarantine(spark, d):
    raw = faulty(spark, d).drop("Amount").withColumnRenamed("raw", "Amount")
    bad = scoring.quarantined_rows(scoring.with_reasons(raw, CONTRACT))
    return bad.groupBy(F.array_join("reasons", "; ").alias("reasons")).agg(F.count(F.lit(1)).alias("n"))


@query("score_valid_rows", f"""WITH {FAULTY}, ok AS (SELECT row_id, "Time", raw::DOUBLE AS "Amount" FROM faulty WHERE raw IS NOT NULL AND raw NOT IN ('n/a', 'NaN', 'Infinity')),
{TXH.split(', txh AS', 1)[1].join(['txh AS', '']).replace('FROM tx)', 'FROM ok)')} SELECT row_id, round({P}, 6) AS fraud_probability FROM txh""")
def score_valid_rows(spark, d):
    raw = faulty(spark, d).drop("Amount").withColumnRenamed("raw", "Amount")
    good = scoring.valid_rows(scoring.with_reasons(raw, CONTRACT))
    return rounded(scoring.score_rows(good, MODEL, POLICY, CONTRACT, ["row_id"]).select("row_id", "fraud_probability"))


FAULTY_SCORED = f"""ok AS (SELECT row_id, "Time", raw::DOUBLE AS "Amount" FROM faulty WHERE raw IS NOT NULL AND raw NOT IN ('n/a', 'NaN', 'Infinity')),
{TXH.split(', txh AS', 1)[1].join(['txh AS', '']).replace('FROM tx)', 'FROM ok)')}
SELECT f.row_id, round({P}, 6) AS fraud_probability, CASE WHEN {P} >= 0.5 THEN 'fraud' WHEN {P} IS NOT NULL THEN 'legit' END AS predicted_label,
CASE WHEN raw IS NULL THEN 'Amount: missing' WHEN raw = 'n/a' THEN 'Amount: not numeric' WHEN raw = 'NaN' THEN 'Amount: NaN'
WHEN raw = 'Infinity' THEN 'Amount: infinite' ELSE '' END AS reasons FROM faulty f LEFT JOIN txh USING (row_id)"""


@query("score_faulty_batch", f"WITH {FAULTY}, {FAULTY_SCORED}")
def score_faulty_batch(spark, d):
    """Every row is there: scored, or without a score and with its reasons."""
    raw = faulty(spark, d).drop("Amount").withColumnRenamed("raw", "Amount")
    out = scoring.score_rows(raw, MODEL, POLICY, CONTRACT, ["row_id"], reasons=True)
    return rounded(out.select("row_id", "fraud_probability", "predicted_label", F.array_join("reasons", "; ").alias("reasons")))


# Monitoring --------------------------------------------------------------------------------------------------

def requests(spark, d):
    """Scored requests with a latency derived from the props of each event."""
    e = tables.event_time(tables.sample_table(spark, d, "events"))
    return e.select("ts", "user_id", "event_type", F.col("value").alias("Amount"),
                    F.get_json_object("props", "$.k").cast("double").alias("latency_ms"))


def seconds(df, *columns):
    """Window bounds as epoch seconds, which compare without time zones."""
    return df.withColumns({c: F.unix_seconds(c) for c in columns})


@query("alert_rate_windows", f"""WITH w AS (SELECT ({EPOCH}) // 3600 * 3600 AS s, count(*) AS requests, count(*) FILTER (value >= 100) AS alerts,
count(*) FILTER (event_type = 'error') AS errors FROM events GROUP BY 1)
SELECT s AS window_start, s + 3600 AS window_end, requests, alerts, errors, round(alerts::DOUBLE / requests, 6) AS alert_rate,
round(errors::DOUBLE / requests, 6) AS error_rate FROM w""")
def alert_rate_windows(spark, d):
    w = monitor.request_windows(requests(spark, d), alert=F.col("Amount") >= 100, failed=F.col("event_type") == "error")
    return rounded(seconds(w, "window_start", "window_end"))


@query("sliding_alert_windows", f"""WITH e AS (SELECT ({EPOCH}) // 21600 * 21600 - unnest([0, 21600, 43200, 64800]) AS s, value, event_type FROM events)
SELECT s AS window_start, s + 86400 AS window_end, count(*) AS requests, count(*) FILTER (value >= 100) AS alerts, 0::BIGINT AS errors,
round(count(*) FILTER (value >= 100)::DOUBLE / count(*), 6) AS alert_rate, 0.0::DOUBLE AS error_rate FROM e GROUP BY 1""")
def sliding_alert_windows(spark, d):
    w = monitor.request_windows(requests(spark, d), "1 day", "6 hours", alert=F.col("Amount") >= 100)
    return rounded(seconds(w, "window_start", "window_end"))


GROWTH = "ln(1.01::DOUBLE / 0.99::DOUBLE)"


@query("latency_windows", f"""WITH e AS (SELECT ({EPOCH}) // 86400 * 86400 AS s, event_type, json_extract_string(props, '$.k')::DOUBLE AS k FROM events),
b AS (SELECT *, CASE WHEN k > 0 THEN ceil(ln(k) / {GROWTH}) WHEN k <= 0 THEN -2147483648 END AS b FROM e),
q AS (SELECT s, event_type, count(*) AS requests, list_sort(list(b) FILTER (b IS NOT NULL)) AS bs FROM b GROUP BY 1, 2),
p AS (SELECT *, bs[floor(0.5 * (len(bs) - 1))::BIGINT + 1] AS b50, bs[floor(0.95::DOUBLE * (len(bs) - 1))::BIGINT + 1] AS b95 FROM q)
SELECT s AS window_start, s + 86400 AS window_end, event_type, requests, 0::BIGINT AS alerts, 0::BIGINT AS errors, 0.0::DOUBLE AS alert_rate, 0.0::DOUBLE AS error_rate,
round(CASE WHEN b50 = -2147483648 THEN 0 ELSE exp(b50 * {GROWTH}) * 0.99::DOUBLE END, 6) AS latency_p50,
round(CASE WHEN b95 = -2147483648 THEN 0 ELSE exp(b95 * {GROWTH}) * 0.99::DOUBLE END, 6) AS latency_p95 FROM p""")
def latency_windows(spark, d):
    """Median and 95th percentile within one per cent, from counts per logarithmic bucket."""
    w = monitor.request_windows(requests(spark, d), "1 day", by=["event_type"], latency="latency_ms")
    return rounded(seconds(w, "window_start", "window_end"))


@query("user_sessions", """WITH e AS (SELECT user_id, epoch_us(ts) AS t, lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM events),
s AS (SELECT *, sum(CASE WHEN prev IS NULL OR t - prev > 86400000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY t) AS sid FROM e)
SELECT user_id, min(t) // 1000000 AS session_start, (max(t) + 86400000000) // 1000000 AS session_end, count(*) AS events FROM s GROUP BY user_id, sid""")
def user_sessions(spark, d):
    s = monitor.sessions(requests(spark, d), "user_id", "1 day")
    return seconds(s, "session_start", "session_end")


HALF = 15 * 86400


def _psi_sql(features, by_day: bool) -> str:
    parts = []
    for f in features:
        edges = ", ".join(f'quantile_cont("{f}", {i / 10})' for i in range(1, 10))
        parts.append(f"""SELECT '{f}' AS feature, "Time" < {HALF} AS base, ({EPOCH}) // 86400 * 86400 AS day,
        len(list_filter((SELECT list_distinct([{edges}]) FROM txh WHERE "Time" < {HALF}), lambda e: txh."{f}" > e)) AS bin FROM txh""")
        parts[-1] = parts[-1]
    bins = " UNION ALL ".join(
        f"""SELECT '{f}' AS feature, unnest(range(0, (SELECT len(list_distinct([{", ".join(f'quantile_cont("{f}", {i / 10})' for i in range(1, 10))}])) + 1 FROM txh WHERE "Time" < {HALF}))) AS bin"""
        for f in features)
    day, using = ("day, ", "day, ") if by_day else ("", "")
    keys = "SELECT DISTINCT day FROM l WHERE NOT base" if by_day else "SELECT 1 AS one"
    return f"""l AS ({" UNION ALL ".join(parts)}), bins AS ({bins}), ks AS ({keys}),
e AS (SELECT feature, bin, count(*)::DOUBLE / sum(count(*)) OVER (PARTITION BY feature) AS e FROM l WHERE base GROUP BY 1, 2),
a AS (SELECT {day}feature, bin, count(*) AS c FROM l WHERE NOT base GROUP BY ALL),
n AS (SELECT {day}feature, sum(c)::BIGINT AS n FROM a GROUP BY ALL),
j AS (SELECT {day}feature, n, greatest(coalesce(c, 0)::DOUBLE / n, 1e-6) AS a, greatest(coalesce(e, 0), 1e-6) AS e
 FROM (SELECT * FROM bins, ks) b JOIN n USING ({using}feature) LEFT JOIN a USING ({using}feature, bin) LEFT JOIN e USING (feature, bin))
SELECT {"day AS window_start, " if by_day else ""}feature, n AS row_count, round(sum((a - e) * ln(a / e)), 6) AS psi FROM j GROUP BY {day}feature, n"""


PSI_FEATURES = ("Amount", "Hour", "Amount_log1p")


def halves(spark, d):
    t = txh(spark, d)
    return t.where(F.col("Time") < HALF), t.where(F.col("Time") >= HALF)


#: Sines of hours that mirror each other are one value: functions of different libraries differ in the last bit.
TXH_EXACT = TXH.replace("sin(2*pi()", "round(sin(2*pi()").replace("AS hour_sin", ", 9) AS hour_sin").replace("cos(2*pi()", "round(cos(2*pi()").replace("AS hour_cos", ", 9) AS hour_cos")


def drift_halves(spark, d):
    cycle = {c: F.round(c, 9) + 0.0 for c in ("hour_sin", "hour_cos")}
    return [half.withColumns(cycle) for half in halves(spark, d)]


@query("psi_features", f"WITH {TXH_EXACT}, " + _psi_sql(monitor.DRIFT_FEATURES, False))
def psi_features(spark, d):
    train, live = drift_halves(spark, d)
    return rounded(monitor.psi(live, monitor.fit_drift(train)))


@query("psi_by_day", f"WITH {TXH_EXACT}, " + _psi_sql(monitor.DRIFT_FEATURES, True))
def psi_by_day(spark, d):
    train, live = drift_halves(spark, d)
    return rounded(seconds(monitor.psi_windows(live, monitor.fit_drift(train)), "window_start"))


def scored_requests(spark, d):
    s = scoring.score_rows(tx(spark, d), MODEL, POLICY, CONTRACT, ["row_id", "ts", "Class"])
    return s.select("row_id", "ts", F.col("Class").alias("label"), F.col("fraud_probability").alias("score"))


PERF = f"""pf AS (SELECT ({EPOCH}) // 86400 * 86400 AS day, count(*) FILTER (p >= 0.5 AND "Class" = 1) AS tp, count(*) FILTER (p >= 0.5 AND "Class" = 0) AS fp,
count(*) FILTER (p < 0.5 AND "Class" = 0) AS tn, count(*) FILTER (p < 0.5 AND "Class" = 1) AS fn FROM sco GROUP BY 1),
pq AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0 ELSE tp::DOUBLE / (tp + fp) END AS precision, CASE WHEN tp + fn = 0 THEN 0 ELSE tp::DOUBLE / (tp + fn) END AS recall,
CASE WHEN 2*tp + fp + fn = 0 THEN 0 ELSE 2.0::DOUBLE * tp / (2*tp + fp + fn) END AS f1, (tp + fp)::DOUBLE / (tp + fp + tn + fn) AS alert_rate FROM pf)"""


@query("performance_by_day", f"""WITH {SCORED}, {PERF} SELECT day AS window_start, tp, fp, tn, fn, round(precision, 6) AS precision, round(recall, 6) AS recall,
round(f1, 6) AS f1, round(5.0::DOUBLE * (precision * recall) / greatest(4.0::DOUBLE * precision + recall, 1e-12), 6) AS f2, round(alert_rate, 6) AS alert_rate,
round(precision - 0.2, 6) AS precision_change, round(recall - 0.5, 6) AS recall_change FROM pq""")
def performance_by_day(spark, d):
    w = monitor.performance_windows(scored_requests(spark, d), POLICY.threshold)
    return rounded(seconds(monitor.performance_drift(w, {"precision": 0.2, "recall": 0.5}), "window_start"))


LIMITS = monitor.RetrainLimits(psi=0.001, min_precision=0.2, max_recall_drop=0.05, max_alert_rate_ratio=1.05)
AT = {"recall": 0.5, "alert_rate": 0.5}


@query("retrain_triggers", f"""WITH {SCORED}, {PERF}, ps AS (SELECT * FROM (WITH {TXH}, {_psi_sql(PSI_FEATURES, False)}))
SELECT 'psi_above_limit' AS rule, feature AS subject, psi AS value, 0.001::DOUBLE AS limit_value, psi > 0.001 AS fired FROM ps
UNION ALL SELECT 'precision_below_target', day::VARCHAR, round(precision, 6), 0.2, precision < 0.2 FROM pq
UNION ALL SELECT 'recall_degraded', day::VARCHAR, round(recall, 6), 0.45, recall < 0.45 FROM pq
UNION ALL SELECT 'alert_rate_shift', day::VARCHAR, round(alert_rate, 6), 0.525, alert_rate > 0.525 FROM pq""")
def retrain_triggers(spark, d):
    train, live = halves(spark, d)
    drift = monitor.psi(live, monitor.fit_drift(train, PSI_FEATURES))
    perf = monitor.performance_windows(scored_requests(spark, d), POLICY.threshold)
    return rounded(monitor.retrain_triggers(drift, perf, AT, LIMITS))


# Streams -----------------------------------------------------------------------------------------------------

@query("stream_scored", f"""WITH e AS (SELECT event_id AS row_id, epoch_us(ts) / 1e6::DOUBLE - 1704067200 AS "Time", value AS "Amount" FROM events),
{TXH.split(', txh AS', 1)[1].join(['txh AS', '']).replace('FROM tx)', 'FROM e)')} SELECT row_id, round({P}, 6) AS fraud_probability,
CASE WHEN {P} >= 0.5 THEN 'fraud' ELSE 'legit' END AS predicted_label FROM txh""")
def stream_scored(spark, d):
    e = jobs.stream_events(spark, d)
    since = (F.unix_micros("ts") / F.lit(1e6)) - F.lit(1704067200)  # a stream has no minimum; its epoch is fixed
    raw = e.select(F.col("event_id").alias("row_id"), since.alias("Time"), F.col("value").alias("Amount"))
    out = scoring.score_rows(raw, MODEL, POLICY, CONTRACT, ["row_id"]).select("row_id", "fraud_probability", "predicted_label")
    return rounded(jobs.run_available(out, "scored"))


FAULTY_EVENTS = """tx AS (SELECT event_id AS row_id, epoch_us(ts) / 1e6::DOUBLE - 1704067200 AS "Time", value AS "Amount", 0 AS "Class" FROM events), """


@query("score_faulty_stream", f"WITH {FAULTY_EVENTS}{FAULTY[FAULTY.index('faulty AS'):]}, {FAULTY_SCORED}")
def score_faulty_stream(spark, d):
    """The same over a stream: no row is lost, no faulty row is labelled."""
    e = jobs.stream_events(spark, d)
    row_id = F.col("event_id")
    amount = (F.when(row_id % 13 == 0, "n/a").when(row_id % 17 == 0, "NaN").when(row_id % 19 == 0, "Infinity")
              .when(row_id % 23 == 0, F.lit(None)).otherwise(F.col("value").cast("string")))
    raw = e.select(row_id.alias("row_id"), ((F.unix_micros("ts") / F.lit(1e6)) - F.lit(1704067200)).alias("Time"), amount.alias("Amount"))
    out = scoring.score_rows(raw, MODEL, POLICY, CONTRACT, ["row_id"], reasons=True)
    return rounded(jobs.run_available(out.select("row_id", "fraud_probability", "predicted_label", F.array_join("reasons", "; ").alias("reasons")), "faulty"))


@query("stream_alert_windows", f"""WITH w AS (SELECT ({EPOCH}) // 3600 * 3600 AS s, count(*) AS requests, count(*) FILTER (value >= 100) AS alerts,
count(*) FILTER (event_type = 'error') AS errors FROM events GROUP BY 1), m AS (SELECT max(epoch_us(ts)) AS m FROM events)
SELECT s AS window_start, s + 3600 AS window_end, requests, alerts, errors, round(alerts::DOUBLE / requests, 6) AS alert_rate,
round(errors::DOUBLE / requests, 6) AS error_rate FROM w, m WHERE (s + 3600) * 1000000 <= m - 3600000000""")
def stream_alert_windows(spark, d):
    e = jobs.stream_events(spark, d).select("ts", "event_type", F.col("value").alias("Amount"))
    w = monitor.request_windows(e, alert=F.col("Amount") >= 100, failed=F.col("event_type") == "error")
    return rounded(seconds(jobs.run_available(w, "alert-windows"), "window_start", "window_end"))


@query("stream_deduplicated", "SELECT event_id AS row_id, value AS amount FROM events")
def stream_deduplicated(spark, d):
    once = jobs.stream_events(spark, d).select(F.col("event_id").alias("row_id"), "ts", F.col("value").alias("amount"))
    twice = once.unionByName(jobs.stream_events(spark, d).select(F.col("event_id").alias("row_id"), "ts", F.col("value").alias("amount")))
    return jobs.run_available(monitor.drop_repeats(twice).drop("ts"), "deduplicated")


@query("stream_late_labels", """SELECT event_id AS row_id, value AS amount, CAST(event_type = 'error' AS INTEGER) AS label FROM events
WHERE event_type <> 'view' AND (event_id % 10) * 86400 <= 7 * 86400""")
def stream_late_labels(spark, d):
    """Labels come in 0 to 9 days late, and views never get one; the join waits seven days."""
    def source():
        return jobs.stream_events(spark, d)
    scores = source().select(F.col("event_id").alias("row_id"), "ts", F.col("value").alias("amount"))
    late = F.timestamp_micros(F.unix_micros("ts") + (F.col("event_id") % 10) * F.lit(86_400_000_000))
    labels = source().where("event_type <> 'view'").select(
        F.col("event_id").alias("row_id"), late.alias("label_ts"), (F.col("event_type") == "error").cast("int").alias("label"))
    joined = monitor.join_late_labels(scores, labels).select("row_id", "amount", "label")
    return jobs.run_available(joined, "late-labels").where(F.col("label").isNotNull())


@query("late_label_performance", """SELECT CASE WHEN l.doc_id IS NULL THEN 'unlabelled' ELSE 'labelled' END AS status, count(*) AS n, coalesce(sum(toxic), 0)::BIGINT AS positives
FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1""")
def late_label_performance(spark, d):
    docs = tables.sample_table(spark, d, "documents").select(F.col("doc_id").alias("row_id"), F.current_timestamp().alias("ts"))
    labels = tables.sample_table(spark, d, "labels").select(
        F.col("doc_id").alias("row_id"), F.current_timestamp().alias("label_ts"), "toxic")
    joined = monitor.join_late_labels(docs, labels)
    status = F.when(F.col("toxic").isNull(), "unlabelled").otherwise("labelled")
    return joined.groupBy(status.alias("status")).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("positives"))


# Two windows in a row beyond a limit make a trigger, then the rule is quiet for five days.
FIRED = f"""f AS (SELECT event_type AS subject, ({EPOCH}) // 86400 * 86400 AS s, avg(value) AS v FROM events GROUP BY 1, 2),
r AS (SELECT *, v > 50 AS fired, lag(s) OVER (PARTITION BY subject ORDER BY s) AS prev, row_number() OVER (PARTITION BY subject ORDER BY s) AS n FROM f)"""
TRIGGERS = f"""WITH RECURSIVE {FIRED},
w AS (SELECT subject, s, v, n, fired::INTEGER AS streak, -4000000000::BIGINT AS triggered, false AS hit FROM r WHERE n = 1
 UNION ALL SELECT subject, s, v, n, streak, CASE WHEN hit THEN s ELSE triggered END, hit FROM (
  SELECT r.subject, r.s, r.v, r.n, CASE WHEN NOT r.fired THEN 0 WHEN r.s - r.prev = 86400 THEN w.streak + 1 ELSE 1 END AS streak, w.triggered,
   r.fired AND (CASE WHEN r.s - r.prev = 86400 THEN w.streak + 1 ELSE 1 END) >= 2 AND r.s - w.triggered >= 432000 AS hit
  FROM w JOIN r ON r.subject = w.subject AND r.n = w.n + 1))
SELECT 'mean_above_limit' AS rule, subject, s AS window_start, streak::INTEGER AS streak, round(v, 6) AS value FROM w WHERE hit"""
POLICY_OF_TRIGGERS = monitor.TriggerPolicy(consecutive=2, cool_down=5 * 86_400)


def mean_rules(events, delay="1 hour"):
    rows = events.withWatermark("ts", delay) if events.isStreaming else events
    means = rows.groupBy(F.window("ts", "1 day").alias("window"), F.col("event_type").alias("subject")).agg(F.avg("value").alias("value"))
    return means.select(F.lit("mean_above_limit").alias("rule"), "subject", F.unix_seconds("window.start").alias("window_start"), "value",
                        (F.col("value") > 50).alias("fired"), *([F.window_time("window").alias("ts")] if events.isStreaming else []))


@query("retrain_trigger_runs", TRIGGERS)
def retrain_trigger_runs(spark, d):
    """Daily means beyond a limit, two days in a row, with a pause between triggers."""
    events = tables.event_time(tables.sample_table(spark, d, "events"))
    return rounded(monitor.triggers(mean_rules(events), POLICY_OF_TRIGGERS))


@query("stream_retrain_triggers", TRIGGERS.replace("WHERE hit", f"WHERE hit AND s + 86400 <= (SELECT max({EPOCH}) - 3600 FROM events)"))
def stream_retrain_triggers(spark, d):
    """The same over a stream, as far as its watermark has closed days: closed windows are written, and a second stream walks them."""
    closed = jobs.stage(mean_rules(jobs.stream_events(spark, d)), "closed-days").withWatermark("ts", "0 seconds")
    return rounded(jobs.run_available(monitor.triggers(closed, POLICY_OF_TRIGGERS), "triggers"))


#: Payload shapes of requests: the row's own amount, then values of other types, other fields and broken texts.
PAYLOAD_SHAPES = ('{"Time": 5, "Amount": ?}', '{"Time": 5.5, "Amount": "12"}', '{"Time": true, "Amount": ?}', '{"Time": null, "Amount": [1]}',
                  '{"Time": 7, "Amount": {"value": ?}}', '{"Time": 7, "Amount": 1e400}', '{"Time": -1, "Amount": -2.5}', '{"Amount": ?}',
                  '{"Time": 1, "Amount": ?, "note": {"Amount": 3}, "extra": []}', 'not json', '[1, 2]', '{"Time": 1, "Amount": ?', '{"Time": 1, "Amount": NaN}', '{}', '7')
_SHAPES_SQL = "[" + ", ".join("'" + s + "'" for s in PAYLOAD_SHAPES) + "]"


def _typed_sql(c: str) -> str:
    t = f"json_type(j, '$.{c}')"
    return f"""CASE WHEN j IS NULL OR NOT list_contains(json_keys(j), '{c}') THEN NULL WHEN {t} = 'NULL' THEN '{c}: null' WHEN {t} = 'VARCHAR' THEN '{c}: string, not a number'
 WHEN {t} = 'BOOLEAN' THEN '{c}: boolean, not a number' WHEN {t} = 'ARRAY' THEN '{c}: list, not a number' WHEN {t} = 'OBJECT' THEN '{c}: object, not a number'
 WHEN isinf(json_extract_string(j, '$.{c}')::DOUBLE) THEN '{c}: infinite' WHEN json_extract_string(j, '$.{c}')::DOUBLE < 0 THEN '{c}: negative' END"""


@query("typed_payloads", f"""WITH {TX}, p AS (SELECT row_id, replace({_SHAPES_SQL}[row_id % {len(PAYLOAD_SHAPES)} + 1], '?', (row_id % 1000)::VARCHAR || '.25') AS t FROM tx),
v AS (SELECT row_id, CASE WHEN json_valid(replace(t, '1e400', '9e999')) AND left(t, 1) = '{{' AND t NOT LIKE '%NaN%' THEN t END AS j FROM p),
k AS (SELECT row_id, j, list_filter(['Time', 'Amount'], lambda c: NOT list_contains(json_keys(j), c)) AS missing,
 list_sort(list_filter(json_keys(j), lambda c: c NOT IN ('Time', 'Amount'))) AS extra FROM v)
SELECT row_id, CASE WHEN j IS NULL THEN 'payload is not a JSON object' ELSE array_to_string(list_concat(list_transform(missing, lambda c: 'missing field: ' || c),
 list_concat(list_transform(extra, lambda c: 'unexpected field: ' || c), list_filter([{_typed_sql('Time')}, {_typed_sql('Amount')}], lambda r: r IS NOT NULL))), '; ') END AS reasons,
 CASE WHEN j IS NOT NULL AND json_type(j, '$.Amount') IN ('UBIGINT', 'BIGINT', 'DOUBLE') AND NOT isinf(json_extract_string(j, '$.Amount')::DOUBLE) THEN json_extract_string(j, '$.Amount')::DOUBLE END AS amount
FROM k""")
def typed_payloads(spark, d):
    """Payloads of every transaction judged by the types of their values."""
    t = tables.transactions(spark, d)
    shapes = F.array(*[F.lit(s) for s in PAYLOAD_SHAPES])
    text = F.replace(F.get(shapes, (F.col("row_id") % len(PAYLOAD_SHAPES)).cast("int")), F.lit("?"), F.concat((F.col("row_id") % 1000).cast("string"), F.lit(".25")))
    found = scoring.parse_typed_payloads(t.select("row_id", text.alias("payload")), CONTRACT)
    return found.select("row_id", F.array_join("reasons", "; ").alias("reasons"), F.when(F.abs("Amount") < float("inf"), F.col("Amount")).alias("amount"))
