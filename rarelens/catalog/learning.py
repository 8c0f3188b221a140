"""Splits, weights, resampling, models, search and explanation."""

from __future__ import annotations

from pyspark.sql import functions as F

from rarelens.catalog.profiling import tx, txh
from rarelens.catalog.registry import TX, TXH, query, rounded
from rarelens.catalog.serving import CONTRACT, MODEL, POLICY, SCORED
from rarelens.operators import evaluation, neighbors, profile, resample, splits, sweep
from rarelens.plans import explain, models, scoring, search
from rarelens.sources import reports, tables

KEYS = ["row_id"]

# Splits ------------------------------------------------------------------------------------------------------


def held_out_sql(source: str, fraction: str, name: str) -> str:
    """CTEs ending in `name`("Class", n, held): per-class size of the held-out part by largest remainder."""
    return f"""{name}_c AS (SELECT "Class", count(*) AS n FROM {source} GROUP BY 1),
{name}_t AS (SELECT sum(n)::DOUBLE AS total, sum(n) - ceil({fraction} * sum(n) - 1e-9) AS kept FROM {name}_c),
{name}_s AS (SELECT "Class", n, floor(kept * n / total) AS base, kept * n / total - floor(kept * n / total) AS rem, kept FROM {name}_c, {name}_t),
{name} AS (SELECT "Class", n, (n - base - CASE WHEN row_number() OVER (ORDER BY rem DESC, "Class") <= kept - sum(base) OVER () THEN 1 ELSE 0 END)::BIGINT AS held FROM {name}_s)"""


RANKED = """rk AS (SELECT *, row_number() OVER (PARTITION BY "Class" ORDER BY md5(row_id || '|42')) AS rn FROM tx)"""


@query("strat_split", f"""WITH {TX}, {RANKED}, {held_out_sql('tx', '0.2', 'te')}
SELECT row_id, rk."Class", CASE WHEN rn <= held THEN 'test' ELSE 'train' END AS split FROM rk JOIN te USING ("Class")""")
def strat_split(spark, d):
    return splits.two_way_split(tx(spark, d).select("row_id", "Class"), "Class", KEYS)


def _three_way_sql(val: str) -> str:
    return f"""WITH {TX}, {RANKED}, {held_out_sql('tx', '0.2', 'te')},
rest AS (SELECT rk.* FROM rk JOIN te USING ("Class") WHERE rn > held), {held_out_sql('rest', val, 'va')},
sp AS (SELECT row_id, rk."Class", CASE WHEN rn <= te.held THEN 'test' WHEN rn <= te.held + va.held THEN 'val' ELSE 'train' END AS split
 FROM rk JOIN te USING ("Class") JOIN va USING ("Class"))"""


@query("three_way_split", _three_way_sql("0.1 / 0.8") + ' SELECT row_id, "Class", split FROM sp')
def three_way_split(spark, d):
    return splits.three_way_split(tx(spark, d).select("row_id", "Class"), "Class", KEYS)


@query("three_way_split_of_rest", _three_way_sql("0.2") + ' SELECT row_id, "Class", split FROM sp')
def three_way_split_of_rest(spark, d):
    return splits.three_way_split(tx(spark, d).select("row_id", "Class"), "Class", KEYS, val_size=0.2, val_of="rest")


@query("split_audit", _three_way_sql("0.1 / 0.8") + """ SELECT split, count(*) AS row_count, sum("Class")::BIGINT AS positives,
round(avg("Class"), 6) AS rate FROM sp GROUP BY 1""")
def split_audit(spark, d):
    return splits.split_audit(three_way_split(spark, d), "Class")


@query("split_overlap", "SELECT 0::BIGINT AS shared_keys")
def split_overlap(spark, d):
    return splits.split_overlap(three_way_split(spark, d), KEYS)


@query("kfold", f"""WITH {TX} SELECT row_id, "Class", (ntile(5) OVER (PARTITION BY "Class" ORDER BY md5(row_id || '|42')) - 1)::INTEGER AS fold FROM tx""")
def kfold(spark, d):
    return splits.k_folds(tx(spark, d).select("row_id", "Class"), "Class", KEYS)


@query("undersample", f"""WITH {TX}, {RANKED}, m AS (SELECT min(n) AS m FROM (SELECT count(*) AS n FROM tx GROUP BY "Class"))
SELECT row_id, "Class" FROM rk, m WHERE rn <= m""")
def undersample(spark, d):
    return splits.undersample(tx(spark, d).select("row_id", "Class"), "Class", KEYS)


@query("class_weights", f"""WITH {TX}, c AS (SELECT "Class", count(*) AS n, sum(count(*)) OVER () AS t FROM tx GROUP BY 1)
SELECT "Class", round(t::DOUBLE / (2 * n), 6) AS balanced, round(CASE WHEN "Class" = 1 THEN (t - n)::DOUBLE / n ELSE 1 END, 6) AS auto,
CASE WHEN "Class" = 1 THEN 20.0::DOUBLE ELSE 1.0::DOUBLE END AS custom, 1.0::DOUBLE AS uniform FROM c""")
def class_weights(spark, d):
    t = tx(spark, d)
    w = t.select("Class", *[splits.class_weight(t, "Class", m).alias(n) for n, m in (
        ("balanced", "balanced"), ("auto", "auto"), ("custom", 20.0), ("uniform", "none"))])
    return rounded(w.groupBy("Class").agg(*[F.max(c).alias(c) for c in ("balanced", "auto", "custom", "uniform")]))


# Neighbours and over-sampling --------------------------------------------------------------------------------

MINORITY = "mn AS (SELECT vec_id AS id, embedding[1:16]::DOUBLE[] AS v FROM embeddings WHERE label = 0)"
NEAR = MINORITY + """, nn AS (SELECT a.id, b.id AS neighbor, b.v AS neighbor_vector, list_distance(a.v, b.v) AS distance,
row_number() OVER (PARTITION BY a.id ORDER BY list_distance(a.v, b.v), b.id) AS rank FROM mn a, mn b WHERE a.id <> b.id)"""
DIMS = [f"e{i}" for i in range(16)]


@query("nearest_neighbours", f"WITH {NEAR} SELECT id, rank::INTEGER AS rank, neighbor, round(distance, 5) AS distance FROM nn WHERE rank <= 5")
def nearest_neighbours(spark, d):
    e = tables.sample_table(spark, d, "embeddings").where("label = 0")
    points = e.select(F.col("vec_id").alias("id"), F.slice("embedding", 1, 16).cast("array<double>").alias("v"))
    return rounded(neighbors.k_nearest(points, 5).drop("neighbor_vector"), 5)


def _unit(*parts: str) -> str:
    return f"(('0x' || substr(md5({' || '.join(parts)}), 1, 12))::BIGINT / 281474976710656.0::DOUBLE)"


@query("smote", f"""WITH {NEAR}, sz AS (SELECT (SELECT count(*) FROM mn) AS h, floor(0.5 * (SELECT count(*) FROM embeddings WHERE label <> 0))::BIGINT - (SELECT count(*) FROM mn) AS w),
q AS (SELECT id, v, w // h + CASE WHEN row_number() OVER (ORDER BY md5(id || '|42-quota')) <= w % h THEN 1 ELSE 0 END AS quota FROM mn, sz),
b AS (SELECT id, v, unnest(range(1, quota + 1)) AS draw FROM q),
r AS (SELECT *, floor({_unit("id", "'|'", "draw", "'|42-neighbor'")} * 5) + 1 AS rank, {_unit("id", "'|'", "draw", "'|42-gap'")} AS gap FROM b)
SELECT 1 AS "Class", r.id AS base, neighbor, round(gap, 6) AS gap, """ + ", ".join(
    f"round(r.v[{i + 1}] + gap * (neighbor_vector[{i + 1}] - r.v[{i + 1}]), 6) AS {c}" for i, c in enumerate(DIMS))
    + " FROM r JOIN nn ON r.id = nn.id AND r.rank = nn.rank")
def smote(spark, d):
    e = tables.embedding_features(spark, d, 16)
    return rounded(resample.smote(e, DIMS, "Class", "vec_id", ratio=0.5))


# Models ------------------------------------------------------------------------------------------------------

FEATURES = tuple(f"e{i}" for i in range(12))


def learning_table(spark, d):
    return tables.embedding_features(spark, d, len(FEATURES))


def three_parts(spark, d):
    parts = splits.three_way_split(learning_table(spark, d), "Class", ["vec_id"], 0.25, 0.25)
    return {s: parts.where(F.col("split") == s).drop("split") for s in ("train", "val", "test")}


SPECS = {
    "logreg": models.ModelSpec("logreg", {"C": 1.0, "max_iter": 50}, FEATURES, scaler="standard", weights="balanced"),
    "logreg_robust": models.ModelSpec("logreg", {"C": 0.1, "max_iter": 50}, FEATURES, scaler="robust", weights="auto"),
    "decision_tree": models.ModelSpec("decision_tree", {"max_depth": 5, "min_leaf": 5}, FEATURES, weights="balanced"),
    "random_forest": models.ModelSpec("random_forest", {"n_estimators": 20, "max_depth": 5}, FEATURES, weights="balanced"),
    "boosted_trees": models.ModelSpec("boosted_trees", {"n_estimators": 5, "max_depth": 3, "learning_rate": 0.3}, FEATURES, weights="auto"),
}

for _name, _spec in SPECS.items():
    @query(f"model_{_name}")
    def fit_and_evaluate(spark, d, spec=_spec):
        """Quality depends on the learner, so tests check invariants instead of SQL."""
        parts = three_parts(spark, d)
        scored = models.score_model(spec.fit(parts["train"]), parts["test"])
        return rounded(evaluation.evaluate(scored, 0.5))


@query("model_early_stopping")
def early_stopping(spark, d):
    parts = three_parts(spark, d)
    model = models.ModelSpec("boosted_trees", {"n_estimators": 8, "max_depth": 2, "learning_rate": 0.5}, FEATURES).fit(
        parts["train"], parts["val"])
    scored = models.score_model(model, parts["test"])
    return rounded(evaluation.evaluate(scored, 0.5).withColumn("trees", F.lit(model.stages[-1].getNumTrees)))


@query("model_importances")
def model_importances(spark, d):
    model = SPECS["random_forest"].fit(three_parts(spark, d)["train"])
    return rounded(models.importances(model, spark))


@query("model_coefficients")
def model_coefficients(spark, d):
    model = SPECS["logreg"].fit(three_parts(spark, d)["train"])
    return rounded(models.importances(model, spark))


@query("shallow_tree_rules")
def shallow_tree_rules(spark, d):
    """One row per line of a depth-3 tree."""
    spec = models.ModelSpec("decision_tree", {"max_depth": 3, "min_leaf": 5}, FEATURES, weights="balanced")
    lines = models.tree_rules(spec.fit(three_parts(spark, d)["train"])).splitlines()
    return spark.createDataFrame(list(enumerate(lines)), "line int, rule string")


@query("model_save_load")
def model_save_load(spark, d):
    """A fitted pipeline written to the shared folder, read back and used."""
    from rarelens.session import scratch_path
    parts, path = three_parts(spark, d), scratch_path(spark, "model")
    models.save_model(SPECS["logreg"].fit(parts["train"]), path)
    return rounded(evaluation.evaluate(models.score_model(models.load_model(path), parts["test"]), 0.5))


@query("trained_model_compare")
def trained_model_compare(spark, d):
    parts = three_parts(spark, d)
    fitted = {n: SPECS[n].fit(parts["train"]) for n in ("logreg", "decision_tree")}
    return rounded(evaluation.compare_models(search.score_models(fitted, parts["test"]))).orderBy("thr_cost_cost_per_tx")


@query("grid_search")
def grid_search(spark, d):
    spec = models.ModelSpec("decision_tree", {}, FEATURES, weights="balanced")
    options = search.grid({"maxDepth": [2, 4], "minInstancesPerNode": [1, 10], "impurity": ["gini", "entropy"]})
    result = search.cross_validate(spec, learning_table(spark, d), ["vec_id"], options, 3, models.RecallEvaluator())
    return rounded(result.table)


@query("random_search_forest")
def random_search_forest(spark, d):
    options = search.draw({"numTrees": [5, 10, 20], "maxDepth": [3, 5, 8], "minInstancesPerNode": [1, 5],
                           "featureSubsetStrategy": ["sqrt", "log2"]}, 3)
    spec = models.ModelSpec("random_forest", {"n_estimators": 5}, FEATURES, weights="balanced")
    return rounded(search.cross_validate(spec, learning_table(spark, d), ["vec_id"], options, 3).table)


@query("random_search_boosted")
def random_search_boosted(spark, d):
    options = search.draw({"maxIter": [3, 5], "maxDepth": [2, 3], "stepSize": [0.1, 0.3], "subsamplingRate": [0.7, 1.0]}, 2)
    spec = models.ModelSpec("boosted_trees", {"n_estimators": 3}, FEATURES, weights="auto")
    return rounded(search.cross_validate(spec, learning_table(spark, d), ["vec_id"], options, 2).table)


@query("pick_regularisation")
def pick_regularisation(spark, d):
    parts = three_parts(spark, d)
    best, table = search.pick_c(SPECS["logreg"], parts["train"], parts["val"], [0.01, 1.0, 100.0])
    return rounded(table.withColumn("chosen", F.col("C") == best))


@query("refit_top_configs")
def refit_top_configs(spark, d):
    parts = three_parts(spark, d)
    rows = search.refit_top(SPECS["decision_tree"], [{"max_depth": 3}, {"max_depth": 5}], parts["train"], parts["val"],
                            parts["test"], 0.5)
    return rounded(rows.drop("runtime_s"))


@query("ab_feature_test")
def ab_feature_test(spark, d):
    spec = models.ModelSpec("random_forest", {"n_estimators": 10, "max_depth": 4}, FEATURES, weights="balanced")
    rows, _ = search.ab_test(spec, {"baseline": FEATURES[:6], "extended": FEATURES}, three_parts(spark, d), [1, 2], 0.5)
    return rounded(rows)


@query("ab_summary")
def ab_summary(spark, d):
    spec = models.ModelSpec("decision_tree", {"max_depth": 4}, FEATURES, weights="balanced")
    _, summary = search.ab_test(spec, {"baseline": FEATURES[:6], "extended": FEATURES}, three_parts(spark, d), [1], 0.5)
    return rounded(summary)


@query("cross_val_smote")
def cross_val_smote(spark, d):
    """Scale, over-sample, fit: in this order inside every training fold."""
    spec = models.ModelSpec("logreg", {"max_iter": 20}, FEATURES, scaler="standard", weights="balanced", resample={"key": "vec_id", "ratio": 0.3})
    return rounded(search.score_spread(search.cross_val_score(spec, learning_table(spark, d), ["vec_id"], 2)))


ALL_DIMENSIONS = [f"e{i}" for i in range(64)]


@query("fit_only_resampling", """WITH t AS (SELECT vec_id, (label = 0)::INTEGER AS y, embedding FROM embeddings WHERE vec_id % 4 <> 0),
c AS (SELECT sum(y) AS pos, count(*) - sum(y) AS neg FROM t), g AS (SELECT *, floor(0.3 * neg)::BIGINT AS grown FROM c),
x AS (SELECT f - 1 AS f, embedding[f]::DOUBLE AS v FROM t, range(1, 65) r(f))
SELECT 'e' || f AS feature, round(avg(v), 6) AS center, round(stddev_pop(v), 6) AS scale, (SELECT neg + grown FROM g)::BIGINT AS fitted_rows, (SELECT grown FROM g)::BIGINT AS fitted_positives,
round((SELECT (neg + grown) / (2.0::DOUBLE * grown) FROM g), 6) AS positive_weight, (SELECT count(*) FROM t) AS transformed_rows FROM x GROUP BY f""")
def fit_only_resampling(spark, d):
    """A scaler fitted on raw rows before over-sampling, what the classifier would be fitted on, and how many rows come out of a transform."""
    from rarelens.plans.fitonly import TrainingPipeline
    spec = models.ModelSpec("logreg", {}, ALL_DIMENSIONS, scaler="standard", weights="balanced", resample={"key": "vec_id", "ratio": 0.3})
    train = spec.training_table(tables.embedding_features(spark, d, 64).where("vec_id % 4 <> 0"), ["vec_id"])
    fitted, rows = TrainingPipeline(stages=spec.steps()).prepare(train)
    seen = rows.agg(F.count("*"), F.sum("label").cast("long"), F.max(F.when(F.col("label") == 1, F.col("_weight")))).first()
    out = train
    for stage in fitted:
        out = stage.transform(out)
    centers, scales, n = fitted[0].getOrDefault("centers"), fitted[0].getOrDefault("scales"), out.count()
    lines = [(c, a, b, seen[0], seen[1], seen[2], n) for c, a, b in zip(ALL_DIMENSIONS, centers, scales)]
    return rounded(spark.createDataFrame(lines, "feature string, center double, scale double, fitted_rows long, fitted_positives long, positive_weight double, transformed_rows long"))


# Result tables -----------------------------------------------------------------------------------------------

# Runs stand in for model families: each order priority is a family, each order a run with a score.
RUNS = """runs AS (SELECT o_orderpriority AS model, o_orderkey AS candidate, o_totalprice / 1000 AS mean_test_score FROM orders)"""


def runs(spark, d):
    return tables.sample_table(spark, d, "orders").select(
        F.col("o_orderpriority").alias("model"), F.col("o_orderkey").alias("candidate"),
        (F.col("o_totalprice") / 1000).alias("mean_test_score"))


@query("best_by_family", f"WITH {RUNS} SELECT model, round(max(mean_test_score), 6) AS best_mean_test_score FROM runs GROUP BY 1")
def best_by_family(spark, d):
    return rounded(reports.best_by_family(runs(spark, d)))


@query("run_summary", f"WITH {RUNS} SELECT model, round(avg(mean_test_score), 6) AS mean_test_score_mean, round(stddev_samp(mean_test_score), 6) AS mean_test_score_std FROM runs GROUP BY 1")
def run_summary(spark, d):
    return rounded(profile.run_summary(runs(spark, d), ["mean_test_score"], "model"))


@query("rank_families", f"""WITH {RUNS}, b AS (SELECT model, max(mean_test_score) AS best_mean_test_score FROM runs GROUP BY 1)
SELECT model, round(best_mean_test_score, 6) AS best_mean_test_score, rank() OVER (ORDER BY best_mean_test_score DESC)::INTEGER AS rank FROM b""")
def rank_families(spark, d):
    return rounded(profile.rank_results(reports.best_by_family(runs(spark, d)), "best_mean_test_score"))


@query("stacked_results", f"""WITH {RUNS} SELECT model, candidate, round(mean_test_score, 6) AS mean_test_score, NULL::VARCHAR AS note FROM runs
UNION ALL SELECT c_mktsegment, c_custkey, NULL, 'segment' FROM customer""")
def stacked_results(spark, d):
    other = tables.sample_table(spark, d, "customer").select(
        F.col("c_mktsegment").alias("model"), F.col("c_custkey").alias("candidate"), F.lit("segment").alias("note"))
    return rounded(reports.stack_results([runs(spark, d), other]))


@query("experiment_log", f"""WITH {SCORED}, g AS (SELECT unnest([0.3::DOUBLE, 0.5::DOUBLE]) AS t)
SELECT 'linear' AS model, 'test' AS stage, '{{"threshold": ' || t || '}}' AS params_json, count(*) FILTER (p >= t AND "Class" = 1) AS tp,
count(*) FILTER (p >= t AND "Class" = 0) AS fp FROM sco, g GROUP BY t""")
def experiment_log(spark, d):
    from rarelens.session import scratch_path
    scored = scoring.score_rows(tx(spark, d), MODEL, POLICY, CONTRACT, ["Class"]).select(
        F.col("Class").alias("label"), F.col("fraud_probability").alias("score"))
    path = scratch_path(spark, "experiment-log")
    for t in (0.3, 0.5):
        counts = evaluation.confusion(scored, t).select("tp", "fp")
        reports.append_results(reports.result_rows(spark, "linear", "test", {"threshold": t}, counts, 0.0), path)
    return reports.read_results(spark, path).drop("runtime_s")


@query("train_plus_validation", _three_way_sql("0.1 / 0.8") + " SELECT row_id, \"Class\" FROM sp WHERE split <> 'test'")
def train_plus_validation(spark, d):
    s = three_way_split(spark, d)
    return s.where("split = 'train'").unionByName(s.where("split = 'val'")).drop("split")


@query("split_table_round_trip", _three_way_sql("0.1 / 0.8") + " SELECT row_id, \"Class\" FROM sp WHERE split = 'val'")
def split_table_round_trip(spark, d):
    from rarelens.session import scratch_path
    path = scratch_path(spark, "splits")
    tables.write_splits(three_way_split(spark, d), path)
    return tables.read_split(spark, path, "val").select("row_id", "Class")


# Explanation -------------------------------------------------------------------------------------------------

def scored_tx(spark, d):
    s = scoring.score_rows(tx(spark, d), MODEL, POLICY, CONTRACT, ["row_id", "Class"])
    return s.select("row_id", F.col("Class").alias("label"), F.col("fraud_probability").alias("score"))


@query("case_picker", f"""WITH {SCORED} SELECT name, row_index, true_label, round(p, 6) AS score FROM (
(SELECT 'true_positive' AS name, row_id AS row_index, "Class" AS true_label, p FROM sco WHERE "Class" = 1 AND p >= 0.5 ORDER BY p DESC, row_id LIMIT 1)
UNION ALL (SELECT 'true_negative', row_id, "Class", p FROM sco WHERE "Class" = 0 AND p < 0.5 ORDER BY p, row_id LIMIT 1)
UNION ALL (SELECT 'borderline', row_id, "Class", p FROM sco ORDER BY abs(p - 0.5), row_id LIMIT 1))""")
def case_picker(spark, d):
    return rounded(explain.pick_cases(scored_tx(spark, d), 0.5))


WEIGHTS = {"Amount_log1p": 0.9, "hour_sin": 0.7, "hour_cos": -0.4}
PHI = TXH + ", phi AS (" + " UNION ALL ".join(
    f"""SELECT row_id, '{f}' AS feature, "{f}" AS value, {w}::DOUBLE * ("{f}" - (SELECT avg("{f}") FROM txh)) AS phi FROM txh"""
    for f, w in WEIGHTS.items()) + ")"


@query("case_list", f"""WITH {SCORED}, c AS ((SELECT 0 AS position, row_id FROM sco WHERE "Class" = 1 AND p >= 0.5 ORDER BY p DESC, row_id LIMIT 1)
UNION ALL (SELECT 1, row_id FROM sco WHERE "Class" = 0 AND p < 0.5 ORDER BY p, row_id LIMIT 1)
UNION ALL (SELECT 2, row_id FROM sco ORDER BY abs(p - 0.5), row_id LIMIT 1))
SELECT min(position)::INTEGER AS position, row_id AS row_index FROM c GROUP BY 2""")
def case_list(spark, d):
    """The picked cases as a JSON document, read back as an ordered list."""
    from rarelens.sources.configs import case_indices
    picked = explain.pick_cases(scored_tx(spark, d), 0.5)
    order = F.when(F.col("name") == "true_positive", 0).when(F.col("name") == "true_negative", 1).otherwise(2)
    entry = F.struct(order.alias("o"), F.struct("name", F.col("row_index").alias("index")).alias("case"))
    document = picked.agg(F.to_json(F.struct(F.transform(
        F.array_sort(F.collect_list(entry)), lambda e: e["case"]).alias("cases"))).alias("value"))  # three cases
    return case_indices(document)


@query("linear_attributions", f"WITH {PHI} SELECT row_id, feature, round(value, 6) AS value, round(phi, 6) AS phi FROM phi")
def linear_attributions(spark, d):
    t = txh(spark, d)
    return rounded(explain.linear_attributions(t, t, WEIGHTS))


@query("global_importance", f"WITH {PHI} SELECT feature, round(avg(abs(phi)), 6) AS mean_abs FROM phi GROUP BY 1")
def global_importance(spark, d):
    t = txh(spark, d)
    return rounded(explain.global_importance(explain.linear_attributions(t, t, WEIGHTS)))


@query("dependence_data", f"WITH {PHI} SELECT feature, round(value, 6) AS value, round(phi, 6) AS phi FROM phi WHERE feature = 'Amount_log1p'")
def dependence_data(spark, d):
    t = txh(spark, d)
    return rounded(explain.dependence(explain.linear_attributions(t, t, WEIGHTS), ["Amount_log1p"]))


@query("shapley_importance")
def shapley_importance(spark, d):
    t = txh(spark, d).select("row_id", *WEIGHTS)
    phi = explain.shapley_attributions(t, t, MODEL, list(WEIGHTS), draws=4, background_size=200, score="fraud_probability")
    return rounded(explain.global_importance(phi))


@query("local_explanations")
def local_explanations(spark, d):
    t = txh(spark, d)
    picked = explain.pick_cases(scored_tx(spark, d), 0.5)
    cases = explain.cases_by_index(t, picked.select("row_index").distinct())
    return rounded(explain.local_surrogate(cases, t, MODEL, ["Amount_log1p", "hour_sin", "hour_cos"], 0.5, samples=1000,
                                           top=3, label="Class", score="fraud_probability"))


@query("explanation_ranks", f"""WITH {PHI} SELECT row_id, feature, round(phi, 6) AS phi, row_number() OVER (PARTITION BY row_id ORDER BY abs(phi) DESC, feature)::INTEGER AS rank FROM phi""")
def explanation_ranks(spark, d):
    from pyspark.sql import Window
    t = txh(spark, d)
    by_size = Window.partitionBy("row_id").orderBy(F.desc(F.abs("phi")), "feature")  # a row's few features
    return rounded(explain.linear_attributions(t, t, WEIGHTS).select("row_id", "feature", "phi", F.row_number().over(by_size).alias("rank")))


@query("scored_sweep_pick", f"""WITH {SCORED}, th AS (SELECT unnest([{', '.join(f'{t!r}::DOUBLE' for t in sweep.threshold_grid())}]) AS threshold),
c AS (SELECT threshold, count(*) FILTER (p >= threshold AND "Class" = 0) AS fp, count(*) FILTER (p < threshold AND "Class" = 1) AS fn, count(*) AS n FROM sco, th GROUP BY 1)
SELECT round(threshold, 6) AS threshold, fp, fn FROM c ORDER BY (fp * 1.0::DOUBLE + fn * 20.0::DOUBLE) / n, c.threshold LIMIT 1""")
def scored_sweep_pick(spark, d):
    return rounded(sweep.pick_from_sweep(sweep.sweep(scored_tx(spark, d)), "cost").select("threshold", "fp", "fn"))


PICKED = f"""{SCORED}, c AS ((SELECT 0 AS position, 'true_positive' AS name, row_id FROM sco WHERE "Class" = 1 AND p >= 0.5 ORDER BY p DESC, row_id LIMIT 1)
UNION ALL (SELECT 1, 'true_negative', row_id FROM sco WHERE "Class" = 0 AND p < 0.5 ORDER BY p, row_id LIMIT 1)
UNION ALL (SELECT 2, 'borderline', row_id FROM sco ORDER BY abs(p - 0.5), row_id LIMIT 1)),
k AS (SELECT name, row_id, position, row_number() OVER (PARTITION BY row_id ORDER BY position) AS again FROM c),
u AS (SELECT name, row_id, (row_number() OVER (ORDER BY position) - 1)::INTEGER AS position FROM k WHERE again = 1)"""


@query("case_files", f"""WITH {PICKED} SELECT doc, layout, position, CASE WHEN doc = 'flat' THEN name || '_index' ELSE name END AS name, row_id AS row_index, NULL::VARCHAR AS error
FROM u, (VALUES ('bare', 'list'), ('list', 'list'), ('map', 'map'), ('flat', 'flat')) d(doc, layout)
UNION ALL VALUES ('broken', NULL, NULL, NULL, NULL, 'not a JSON object or list'), ('empty', 'map', NULL, NULL, NULL, 'no case index found in the document')""")
def case_files(spark, d):
    """The picked cases written as files of every layout, with two faulty ones, and read back."""
    from rarelens.session import scratch_path
    from rarelens.sources.configs import read_case_files
    picked = explain.pick_cases(scored_tx(spark, d), 0.5)
    order = F.when(F.col("name") == "true_positive", 0).when(F.col("name") == "true_negative", 1).otherwise(2)
    cases = F.array_sort(F.collect_list(F.struct(order.alias("o"), "name", F.col("row_index").cast("string").alias("i"))))      # three cases
    every = lambda form: F.concat_ws(", ", F.transform("cases", form))
    quote, tie = F.lit('"'), F.concat
    one = lambda c: tie(F.lit('{"name": "'), c["name"], F.lit('", "index": '), c["i"], F.lit("}"))
    docs = {"list": tie(F.lit('{"threshold": 0.5, "cases": ['), every(one), F.lit("]}")), "bare": tie(F.lit("["), every(one), F.lit("]")),
            "map": tie(F.lit('{"cases": {'), every(lambda c: tie(quote, c["name"], F.lit('": {"test_index": '), c["i"], F.lit("}"))), F.lit("}}")),
            "flat": tie(F.lit("{"), every(lambda c: tie(quote, c["name"], F.lit('_index": '), c["i"])), F.lit("}")),
            "broken": F.lit("{not json"), "empty": F.lit('{"cases": {"a": {"b": 1}}}')}
    path = scratch_path(spark, "case-files")
    lines = picked.agg(cases.alias("cases")).select(F.explode(F.array(*[F.struct(F.lit(k).alias("doc"), v.alias("value")) for k, v in docs.items()])).alias("r")).select("r.*")
    lines.write.partitionBy("doc").text(path)
    return read_case_files(spark, path).drop("file")
