"""Curves, sweeps, threshold policies and metric bundles."""

from __future__ import annotations

from pyspark.sql import functions as F

from rarelens.catalog.registry import MODELS, SC, SF, curve_sql, double_list, fbeta_sql, query, rounded
from rarelens.operators import curves, evaluation, sweep, thresholds
from rarelens.sources.tables import scored_lineitems, two_models

GRID = sweep.threshold_grid()
PICKED = "round(threshold, 6) AS threshold, round(precision, 6) AS precision, round(recall, 6) AS recall, tp, fp, tn, fn"


def coarse(spark, d):
    return scored_lineitems(spark, d, "coarse")


def fine(spark, d):
    return scored_lineitems(spark, d, "fine")


def coarse_curve(spark, d):
    return curves.score_curve(coarse(spark, d))


def fine_curve(spark, d):
    return curves.score_curve(fine(spark, d))


def model_curve(spark, d):
    return curves.score_curve(two_models(spark, d), by=["model"])


CC, CF, CM = (f"WITH {SC}, {curve_sql('sc')}", f"WITH {SF}, {curve_sql('sf')}", f"WITH {MODELS}, {curve_sql('models', 'model')}")

# Curves ------------------------------------------------------------------------------------------------------


@query("pr_curve", CC + """ SELECT round(threshold, 6) AS threshold, round(precision, 6) AS precision, round(recall, 6) AS recall FROM pr
UNION ALL SELECT NULL, 1.0, 0.0""")
def pr_curve(spark, d):
    return rounded(curves.pr_curve(coarse_curve(spark, d)))


@query("pr_curve_fine", CF + """ SELECT round(threshold, 6) AS threshold, round(precision, 6) AS precision, round(recall, 6) AS recall FROM pr
UNION ALL SELECT NULL, 1.0, 0.0""")
def pr_curve_fine(spark, d):
    return rounded(curves.pr_curve(fine_curve(spark, d)))


@query("policy_sweep", CC + f""" SELECT round(threshold, 6) AS threshold, round(precision, 6) AS precision, round(recall, 6) AS recall,
round({fbeta_sql(1)}, 6) AS f1, round({fbeta_sql(2)}, 6) AS f2 FROM pr""")
def policy_sweep(spark, d):
    return rounded(curves.policy_sweep(coarse_curve(spark, d)))


@query("roc_curve", CM + """ SELECT model, round(threshold, 6) AS threshold, round(fp::DOUBLE / (n - positives), 6) AS fpr, round(recall, 6) AS tpr FROM pr
UNION ALL SELECT DISTINCT model, NULL, 0.0, 0.0 FROM models""")
def roc_curve(spark, d):
    return rounded(curves.roc_curve(model_curve(spark, d), ["model"]))


AP = "sum(pos::DOUBLE / positives * (tp::DOUBLE / n_at))"
AUC = "sum((cnt - pos)::DOUBLE * ((tp - pos)::DOUBLE + pos / 2.0::DOUBLE)) / (max(positives)::DOUBLE * max(n - positives)::DOUBLE)"


@query("average_precision", CF + f" SELECT round({AP}, 6) AS average_precision FROM cu")
def average_precision(spark, d):
    return rounded(curves.average_precision(fine(spark, d)))


@query("roc_auc", CF + f" SELECT round({AUC}, 6) AS roc_auc FROM cu")
def roc_auc(spark, d):
    return rounded(curves.roc_auc(fine(spark, d)))


@query("ranking_by_model", CM + f""" SELECT model, max(n) AS n, max(positives) AS pos, max(n - positives) AS neg, round({AP}, 6) AS pr_auc,
round({AUC}, 6) AS roc_auc, count(*) AS thresholds FROM cu GROUP BY 1""")
def ranking_by_model(spark, d):
    return rounded(curves.ranking_metrics(model_curve(spark, d), ["model"]))


# Confusion and rates -----------------------------------------------------------------------------------------

def counts_sql(source: str, by: str = "", thresholds=None, extra: str = "") -> str:
    """CTE cm: confusion counts at listed thresholds."""
    k = f"{by}, " if by else ""
    return f"""th AS (SELECT unnest({double_list(thresholds)}) AS threshold),
cm AS (SELECT {k}threshold, count(*) FILTER (score >= threshold AND label = 1) AS tp, count(*) FILTER (score >= threshold AND label = 0) AS fp,
 count(*) FILTER (score < threshold AND label = 0) AS tn, count(*) FILTER (score < threshold AND label = 1) AS fn{extra}
 FROM {source}, th GROUP BY {k}threshold),
rt AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0 ELSE tp::DOUBLE / (tp + fp) END AS precision, CASE WHEN tp + fn = 0 THEN 0 ELSE tp::DOUBLE / (tp + fn) END AS recall,
 CASE WHEN fp + tn = 0 THEN 0 ELSE fp::DOUBLE / (fp + tn) END AS fpr, CASE WHEN 2*tp + fp + fn = 0 THEN 0 ELSE 2.0::DOUBLE * tp / (2*tp + fp + fn) END AS f1,
 (fp * 1.0::DOUBLE + fn * 20.0::DOUBLE) / (tp + fp + tn + fn) AS cost_per_tx FROM cm)"""


@query("confusion", f"WITH {SC}, {counts_sql('sc', '', [0.5])} SELECT tp, fp, tn, fn FROM cm")
def confusion(spark, d):
    return evaluation.confusion(coarse(spark, d), 0.5)


MARGINS = "(sqrt(tp + fp) * sqrt(tp + fn) * sqrt(tn + fp) * sqrt(tn + fn))"
MCC = f"(CASE WHEN {MARGINS} = 0 THEN 0 ELSE (tp::DOUBLE * tn - fp::DOUBLE * fn) / {MARGINS} END)"
F2 = "5.0::DOUBLE * (precision * recall) / greatest(4.0::DOUBLE * precision + recall, 1e-12)"


@query("confusion_rates", f"""WITH {MODELS}, {counts_sql('models', 'model', [0.45])}
SELECT model, tp, fp, tn, fn, round(recall, 6) AS tpr, round(fpr, 6) AS fpr, round(1 - fpr, 6) AS tnr, round(1 - recall, 6) AS fnr,
round((recall + 1 - fpr) / 2, 6) AS balanced_accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
round({F2}, 6) AS f2, round({MCC}, 6) AS mcc, round((tp + tn)::DOUBLE / (tp + fp + tn + fn), 6) AS accuracy, round(1 - fpr, 6) AS specificity,
tp + fp AS predicted_positives, tp + fn AS support_pos, tn + fp AS support_neg FROM rt""")
def confusion_rates(spark, d):
    return rounded(evaluation.with_rates(evaluation.confusion(two_models(spark, d), 0.45, by=["model"])))


@query("metrics_at_threshold", CC + f""", {counts_sql('sc', '', [0.5])}, ag AS (SELECT {AP} AS ap, {AUC} AS auc FROM cu)
SELECT threshold, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, round({F2}, 6) AS f2, round({MCC}, 6) AS mcc,
round(ap, 6) AS pr_auc, round(auc, 6) AS roc_auc, tp, fp, tn, fn, tp + fp + tn + fn AS n, tp + fn AS pos, fp + tn AS neg FROM rt, ag""")
def metrics_at_threshold(spark, d):
    return rounded(evaluation.evaluate(coarse(spark, d), 0.5))


@query("classification_report", f"""WITH {SC}, {counts_sql('sc', '', [0.5])},
a AS (SELECT tn::DOUBLE/(tn+fn) AS p0, tn::DOUBLE/(tn+fp) AS r0, 2.0::DOUBLE*tn/(2*tn+fn+fp) AS f0, tn+fp AS n0, precision AS p1, recall AS r1, f1, tp+fn AS n1, tp, tn FROM rt)
SELECT 0 AS position, '0' AS class, round(p0,4) AS precision, round(r0,4) AS recall, round(f0,4) AS f1, n0 AS support FROM a
UNION ALL SELECT 1, '1', round(p1,4), round(r1,4), round(f1,4), n1 FROM a
UNION ALL SELECT 2, 'accuracy', NULL, NULL, round((tp+tn)::DOUBLE/(n0+n1),4), n0+n1 FROM a
UNION ALL SELECT 3, 'macro avg', round((p0+p1)/2,4), round((r0+r1)/2,4), round((f0+f1)/2,4), n0+n1 FROM a
UNION ALL SELECT 4, 'weighted avg', round((p0*n0+p1*n1)/(n0+n1),4), round((r0*n0+r1*n1)/(n0+n1),4), round((f0*n0+f1*n1)/(n0+n1),4), n0+n1 FROM a""")
def classification_report(spark, d):
    return evaluation.classification_report(coarse(spark, d), 0.5)


# Sweeps ------------------------------------------------------------------------------------------------------

SWEEP = """round(threshold, 6) AS threshold, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
round(1 - fpr, 6) AS specificity, round((recall + 1 - fpr) / 2, 6) AS balanced_accuracy, tp, fp, tn, fn, round(cost_per_tx, 6) AS cost_per_tx"""


@query("sweep", f"WITH {SC}, {counts_sql('sc', '', GRID)} SELECT {SWEEP} FROM rt")
def threshold_sweep(spark, d):
    return rounded(sweep.sweep(coarse(spark, d)))


@query("sweep_by_model", f"WITH {MODELS}, {counts_sql('models', 'model', GRID)} SELECT model, {SWEEP} FROM rt")
def sweep_by_model(spark, d):
    return rounded(sweep.sweep(two_models(spark, d), by=["model"]))


@query("scenario_table", f"WITH {SC}, {counts_sql('sc', '', sweep.SCENARIOS)} SELECT {SWEEP} FROM rt")
def scenario_table(spark, d):
    return rounded(sweep.scenarios(coarse(spark, d)))


for _mode, _order in (("f1", "f1 DESC"), ("youden", "(recall + (1.0 - fpr)) / 2.0 DESC"), ("cost", "cost_per_tx ASC")):
    @query(f"pick_{_mode}", f"WITH {SC}, {counts_sql('sc', '', GRID)} SELECT '{_mode}' AS mode, {SWEEP} FROM rt ORDER BY {_order}, rt.threshold LIMIT 1")
    def pick(spark, d, mode=_mode):
        return rounded(sweep.pick_from_sweep(sweep.sweep(coarse(spark, d)), mode))


@query("pick_none", """SELECT 'none' AS mode, NULL::DOUBLE AS threshold, NULL::DOUBLE AS precision, NULL::DOUBLE AS recall, NULL::DOUBLE AS f1, NULL::DOUBLE AS specificity,
NULL::DOUBLE AS balanced_accuracy, NULL::BIGINT AS tp, NULL::BIGINT AS fp, NULL::BIGINT AS tn, NULL::BIGINT AS fn, NULL::DOUBLE AS cost_per_tx""")
def pick_none(spark, d):
    return sweep.pick_from_sweep(sweep.sweep(coarse(spark, d)), "none")


@query("nearest_threshold", f"WITH {SC}, {counts_sql('sc', '', GRID)} SELECT {SWEEP} FROM rt ORDER BY abs(rt.threshold - 0.1279), rt.threshold LIMIT 1")
def nearest_threshold(spark, d):
    return rounded(sweep.nearest_row(sweep.sweep(coarse(spark, d)), 0.1279))


@query("stability", f"""WITH {SC}, {counts_sql('sc', '', GRID)}, p AS (SELECT * FROM rt ORDER BY cost_per_tx, threshold LIMIT 1),
l AS (SELECT rt.* FROM rt, p ORDER BY abs(rt.threshold - greatest(0.01::DOUBLE, p.threshold - 0.02::DOUBLE)), rt.threshold LIMIT 1),
r AS (SELECT rt.* FROM rt, p ORDER BY abs(rt.threshold - least(0.99::DOUBLE, p.threshold + 0.02::DOUBLE)), rt.threshold LIMIT 1)
SELECT """ + ", ".join(
    (f"round({t}.{c}, 6) AS {c}{s}" if c in ("threshold", "precision", "recall") else f"{t}.{c} AS {c}{s}")
    for t, s in (("p", ""), ("l", "_left"), ("r", "_right")) for c in ("threshold", "precision", "recall", "tp", "fp", "fn")) + " FROM p, l, r")
def stability(spark, d):
    return rounded(sweep.stability(sweep.sweep(coarse(spark, d))))


NAMED = {"locked_precision": 0.62, "cost_reference": 0.205, "recall_first": 0.21}


@query("policy_compare", f"""WITH {SC}, {counts_sql('sc', '', sorted(NAMED.values()))}, nm AS (SELECT * FROM (VALUES """ + ", ".join(
    f"('{k}', {v}::DOUBLE)" for k, v in NAMED.items()) + """) v(policy_name, threshold))
SELECT policy_name, threshold, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, tp, fp, fn, tn, tp + fp AS alerts,
round((tp + fp)::DOUBLE / (tp + fp + tn + fn), 6) AS alert_rate, round((tp + fp) * 10000.0::DOUBLE / (tp + fp + tn + fn), 6) AS alerts_per_10k,
round(fn * 10000.0::DOUBLE / (tp + fp + tn + fn), 6) AS missed_per_10k, round(cost_per_tx, 6) AS cost_per_tx,
recall >= 0.9 AS meets_recall_090, precision >= 0.1 AS meets_precision_010, precision >= 0.8 AS meets_precision_080 FROM rt JOIN nm USING (threshold)""")
def policy_compare(spark, d):
    return rounded(sweep.compare_policies(coarse(spark, d), NAMED))


# Threshold policies ------------------------------------------------------------------------------------------

def best_sql(order: str, where: str = "TRUE", extra: str = "") -> str:
    return f"SELECT {PICKED}{extra} FROM pr WHERE {where} ORDER BY {order}, pr.threshold LIMIT 1"


@query("thr_recall_target", CC + " " + best_sql("pr.precision DESC", "recall >= 0.9", ", TRUE AS meets_target"))
def thr_recall_target(spark, d):
    return rounded(thresholds.recall_target(coarse_curve(spark, d)))


@query("thr_recall_target_unreachable", CC + " " + best_sql("pr.recall DESC", extra=", FALSE AS meets_target"))
def thr_recall_target_unreachable(spark, d):
    return rounded(thresholds.recall_target(coarse_curve(spark, d), target=1.5))


@query("thr_max_f2", CC + f", fb AS (SELECT *, {fbeta_sql(2, True)} AS f_beta FROM pr) SELECT {PICKED}, round(f_beta, 6) AS f_beta FROM fb ORDER BY fb.f_beta DESC, fb.threshold LIMIT 1")
def thr_max_f2(spark, d):
    return rounded(thresholds.max_f_beta(coarse_curve(spark, d)))


@query("thr_max_f1_fine", CF + f", fb AS (SELECT *, {fbeta_sql(1)} AS f_beta FROM pr) SELECT {PICKED}, round(f_beta, 6) AS f_beta FROM fb ORDER BY fb.f_beta DESC NULLS LAST, fb.threshold LIMIT 1")
def thr_max_f1_fine(spark, d):
    return rounded(thresholds.max_f_beta(fine_curve(spark, d), beta=1.0, undefined_as_zero=False))


@query("thr_precision_harness", CC + " " + best_sql("pr.recall DESC", "precision >= 0.9",
                                                    ", 0.9::DOUBLE AS target_precision, NULL::VARCHAR AS note"))
def thr_precision_harness(spark, d):
    return rounded(thresholds.precision_or_null(coarse_curve(spark, d), target=0.9))


@query("thr_precision_unreachable", """SELECT NULL::DOUBLE AS threshold, NULL::DOUBLE AS precision, NULL::DOUBLE AS recall, NULL::BIGINT AS tp, NULL::BIGINT AS fp,
NULL::BIGINT AS tn, NULL::BIGINT AS fn, 1.1::DOUBLE AS target_precision, 'no threshold reaches the target precision' AS note""")
def thr_precision_unreachable(spark, d):
    return thresholds.precision_or_null(coarse_curve(spark, d), target=1.1)


@query("thr_precision_ab", CM + f"""SELECT model, {PICKED}, TRUE AS meets_constraint FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY recall DESC, threshold) AS rn
FROM pr WHERE precision >= 0.75) WHERE rn = 1""")
def thr_precision_ab(spark, d):
    return rounded(thresholds.precision_or_best(model_curve(spark, d), ["model"], 0.75))


@query("thr_precision_ab_fallback", CC + " " + best_sql("pr.precision DESC", extra=", FALSE AS meets_constraint"))
def thr_precision_ab_fallback(spark, d):
    return rounded(thresholds.precision_or_best(coarse_curve(spark, d), target=1.1))


@query("thr_precision_policy", CF + " " + best_sql("0::DOUBLE", "precision >= 0.8", ", TRUE AS meets_constraint"))
def thr_precision_policy(spark, d):
    return rounded(thresholds.smallest_precise(fine_curve(spark, d)))


@query("thr_cost", CF + ", co AS (SELECT *, fp * 1.0::DOUBLE + fn * 2.0::DOUBLE AS cost FROM pr) SELECT "
       + PICKED + ", cost FROM co ORDER BY co.cost, co.threshold LIMIT 1")
def thr_cost(spark, d):
    return rounded(thresholds.min_cost(fine_curve(spark, d), fn_cost=2.0))


def _policies_sql() -> str:
    parts = {"max_f1": best_sql(f"{fbeta_sql(1).replace('precision', 'pr.precision').replace('recall', 'pr.recall')} DESC NULLS LAST"),
             "max_fbeta": best_sql(f"{fbeta_sql(2).replace('precision', 'pr.precision').replace('recall', 'pr.recall')} DESC NULLS LAST"),
             "precision_constraint": best_sql("0::DOUBLE", "precision >= 0.8"),
             "cost_based": best_sql("fp * 1.0::DOUBLE + fn * 20.0::DOUBLE")}
    return CF + " " + " UNION ALL ".join(f"SELECT '{k}' AS policy, * FROM ({v})" for k, v in parts.items())


@query("four_policies", _policies_sql())
def four_policies(spark, d):
    return rounded(thresholds.all_policies(fine_curve(spark, d)))


@query("named_policy", CC + " SELECT 'cost_based' AS policy, * FROM (" + "SELECT " + PICKED
       + ", fp * 1.0::DOUBLE + fn * 20.0::DOUBLE AS cost FROM pr ORDER BY fp * 1.0::DOUBLE + fn * 20.0::DOUBLE, pr.threshold LIMIT 1)")
def named_policy(spark, d):
    return rounded(thresholds.select_threshold(coarse_curve(spark, d), "cost_based"))


TARGETS = (0.5, 0.8, 0.9, 1.0)


@query("recall_at_precision", CC + f", t AS (SELECT unnest({double_list(TARGETS)}) AS target) "
       "SELECT target, round(coalesce(max(recall) FILTER (precision >= target), 0), 6) AS recall FROM pr, t GROUP BY 1")
def recall_at_precision(spark, d):
    return rounded(thresholds.recall_at_precision(coarse_curve(spark, d), TARGETS))


@query("precision_at_recall", CC + f", t AS (SELECT unnest({double_list(TARGETS)}) AS target) "
       "SELECT target, round(coalesce(max(precision) FILTER (recall >= target), 0), 6) AS precision FROM pr, t GROUP BY 1")
def precision_at_recall(spark, d):
    return rounded(thresholds.precision_at_recall(coarse_curve(spark, d), TARGETS))


LIMITS = (0.0001, 0.01, 0.1, 0.5)


@query("recall_at_fpr", CF + f", t AS (SELECT unnest({double_list(LIMITS)}) AS target) "
       "SELECT target, round(coalesce(max(recall) FILTER (fp::DOUBLE / (n - positives) <= target), 0), 6) AS recall FROM pr, t GROUP BY 1")
def recall_at_fpr(spark, d):
    return rounded(thresholds.recall_at_fpr(fine_curve(spark, d), LIMITS))


SHARES = (0.000001, 0.001, 0.01, 0.1)


@query("precision_at_topk", CF + f""", t AS (SELECT unnest({double_list(SHARES)}) AS share),
k AS (SELECT share, max(n_at) FILTER (n_at <= n * share) AS k FROM pr, t GROUP BY 1)
SELECT share, round(threshold, 6) AS threshold, coalesce(n_at, 0) AS alerts, coalesce(tp, 0) AS tp, round(coalesce(precision, 0), 6) AS precision,
round(coalesce(recall, 0), 6) AS recall FROM k LEFT JOIN pr ON n_at = k""")
def precision_at_topk(spark, d):
    return rounded(thresholds.at_top_share(fine_curve(spark, d), SHARES))


# Comparison and locking --------------------------------------------------------------------------------------

def _compare_sql() -> str:
    fields = ("precision", "recall", "f1", "tp", "fp", "fn", "cost_per_tx")
    show = lambda t, p: ", ".join(
        (f"{t}.{f}" if f in ("tp", "fp", "fn") else f"round({t}.{f}, 6)") + f" AS {p}{f}" for f in fields)
    return CM + f""", {counts_sql('models', 'model', sorted({*GRID, 0.5}))},
rk AS (SELECT model, {AP} AS ap, {AUC} AS auc FROM cu GROUP BY 1), h AS (SELECT * FROM rt WHERE threshold = 0.5),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY cost_per_tx, threshold) AS rn FROM rt WHERE list_contains({double_list(GRID)}, threshold)) WHERE rn = 1)
SELECT rk.model, round(auc, 6) AS roc_auc, round(ap, 6) AS pr_auc, {show('h', 'thr_0_50_')}, round(b.threshold, 6) AS thr_cost_best, {show('b', 'thr_cost_')}
FROM rk JOIN h USING (model) JOIN b USING (model)"""


@query("model_compare", _compare_sql())
def model_compare(spark, d):
    return rounded(evaluation.compare_models(two_models(spark, d)))


def _locked_sql() -> str:
    return f"""WITH {SC}, half AS (SELECT *, substr(md5(l_orderkey || '|' || l_linenumber || '|lock'), 1, 1) < '8' AS val FROM sc),
v AS (SELECT label, score FROM half WHERE val), sc_test AS (SELECT label, score FROM half WHERE NOT val), {curve_sql('v')},
ch AS (SELECT threshold AS thr FROM pr WHERE precision >= 0.8 ORDER BY pr.threshold LIMIT 1),
cm AS (SELECT max(thr) AS threshold, count(*) FILTER (score >= thr AND label = 1) AS tp, count(*) FILTER (score >= thr AND label = 0) AS fp,
 count(*) FILTER (score < thr AND label = 0) AS tn, count(*) FILTER (score < thr AND label = 1) AS fn FROM sc_test, ch)
SELECT round(threshold, 6) AS threshold, tp, fp, tn, fn FROM cm"""


@query("locked_evaluation", _locked_sql())
def locked_evaluation(spark, d):
    from rarelens.functions.features import stable_hash
    from rarelens.plans.locking import choose, evaluate_locked
    half = F.substring(stable_hash("l_orderkey", "l_linenumber", seed="lock"), 1, 1) < "8"
    rows = coarse(spark, d).withColumn("val", half)
    policy = choose(rows.where("val"), "precision_constraint")
    return rounded(evaluate_locked(rows.where("NOT val"), policy).select("threshold", "tp", "fp", "tn", "fn"))
