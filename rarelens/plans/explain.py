"""Explanations as distributed jobs.

Attribution cost is set by explicit sample sizes: how many rows are explained, how many background rows stand
in for "feature absent", how many draws per row.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Transformer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rarelens.functions.features import hash_unit, stable_hash
from rarelens.operators.ingest import sample_exact
from rarelens.operators.ordered import hash_bucket, join_on, quantiles, running_totals
from rarelens.plans.scoring import positive_score
from rarelens.session import ship_with_tasks

ship_with_tasks(__name__)

#: Values of a background that is broadcast; a larger one is joined in a shuffle.
BACKGROUND_BROADCAST = 500_000


def pick_cases(scored: DataFrame, threshold: float, key: str = "row_id", label: str = "label",
               score: str = "score") -> DataFrame:
    """Surest true positive, surest true negative and the row nearest the threshold: (name, row_index, true_label, score).

    Lowest key on ties; a kind that does not occur is left out.
    """
    y, s, said = F.col(label), F.col(score), F.col(score) >= F.lit(float(threshold))
    row = F.struct(F.col(key).alias("row_index"), y.alias("true_label"), s.alias("score"))

    def least(order: Column, when: Column) -> Column:
        return F.min_by(row, F.when(when, F.struct(order, F.col(key))))

    agg = scored.agg(
        least(-s, (y == 1) & said).alias("true_positive"), least(s, (y == 0) & ~said).alias("true_negative"),
        least(F.abs(s - F.lit(float(threshold))), F.lit(True)).alias("borderline"))
    names = ("true_positive", "true_negative", "borderline")
    items = F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("case")) for n in names])
    return agg.select(F.explode(items).alias("_i")).where(F.col("_i.case").isNotNull()).select("_i.name", "_i.case.*")


def linear_attributions(rows: DataFrame, background: DataFrame, weights: dict[str, float],
                        key: str = "row_id") -> DataFrame:
    """Exact attributions of a linear margin: weight * (value - background mean). Long: (key, feature, value, phi)."""
    means = background.agg(F.struct(*[F.avg(f).alias(f) for f in weights])).scalar()
    items = [F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value"),
                      (F.lit(float(w)) * (F.col(f) - means[f])).alias("phi")) for f, w in weights.items()]
    return rows.select(key, F.explode(F.array(*items)).alias("_i")).select(key, "_i.*")


def shapley_attributions(rows: DataFrame, background: DataFrame, model: Transformer, features: Sequence[str],
                         draws: int = 32, background_size: int = 100, key: str = "row_id",
                         seed: int | str = 42, score: str | None = None) -> DataFrame:
    """Sampled Shapley values for any model: (key, feature, value, phi).

    Every draw takes one background row and one feature order, walks from the background to the row one
    feature at a time, and credits each change of the score to the feature that moved. All steps of all rows
    are scored by one transform. A row's attributions sum to its score minus its mean background score.
    The background may have any size; without a background row there is no attribution.
    """
    names = list(features)
    vector = F.array(*[F.col(f).cast("double") for f in names])
    stand_ins = sample_exact(background, [key], background_size, seed).select(
        stable_hash(key, seed=seed).alias("_h"), vector.alias("_b"))
    # The background rows are numbered in digest order; a draw picks a number, and the row comes by a join on it.
    points = stand_ins.select(hash_bucket("_h").alias("_bucket"), F.struct("_h", "_b").alias("_at"), "_b", F.lit(1).alias("one"))
    numbered = running_totals(points, [], "_bucket", "_at", ["one"]).select((F.col("one_upto") - 1).cast("long").alias("_pick"), "_b")
    if background_size * len(names) <= BACKGROUND_BROADCAST:
        numbered = F.broadcast(numbered)
    size = stand_ins.agg(F.count(F.lit(1))).scalar()
    drawn = rows.select(key, vector.alias("_x")).withColumn("_draw", F.explode(F.sequence(F.lit(1), F.lit(draws))))
    pick = F.floor(hash_unit(key, "_draw", seed=f"{seed}-background") * size).cast("long")
    drawn = drawn.withColumn("_pick", pick).join(numbered, "_pick")
    order = F.transform(F.array_sort(F.array(*[
        F.struct(stable_hash(key, "_draw", seed=f"{seed}-{f}").alias("h"), F.lit(i).alias("i"))
        for i, f in enumerate(names)])), lambda s: s["i"])
    walks = drawn.select(key, "_x", "_draw", "_b", order.alias("_order"))
    steps = walks.withColumn("_step", F.explode(F.sequence(F.lit(0), F.lit(len(names)))))
    moved = F.slice("_order", F.lit(1), F.col("_step"))
    mixed = {f: F.when(F.array_contains(moved, i), F.col("_x")[i]).otherwise(F.col("_b")[i]) for i, f in enumerate(names)}
    scored = model.transform(steps.withColumns(mixed))
    value = score or "_score"
    if value not in scored.columns:
        scored = positive_score(scored, value)
    # A step's score counts for the feature just moved and against the one moved next.
    gained = F.when(F.col("_step") > 0, F.struct(F.element_at("_order", F.greatest(F.col("_step"), F.lit(1))).alias("i"), F.col(value).alias("v")))
    lost = F.when(F.col("_step") < len(names), F.struct(
        F.element_at("_order", F.least(F.col("_step") + 1, F.lit(len(names)))).alias("i"), (-F.col(value)).alias("v")))
    parts = scored.select(key, "_x", F.explode(F.array_compact(F.array(gained, lost))).alias("_c"))
    phi = parts.groupBy(key, F.col("_c.i").alias("_i")).agg((F.sum("_c.v") / draws).alias("phi"), F.any_value("_x").alias("_x"))
    labels = F.array(*[F.lit(f) for f in names])
    return phi.select(key, labels[F.col("_i")].alias("feature"), F.col("_x")[F.col("_i")].alias("value"), "phi")


def global_importance(attributions: DataFrame) -> DataFrame:
    """(feature, mean_abs) strongest first."""
    out = attributions.groupBy("feature").agg(F.avg(F.abs("phi")).alias("mean_abs"))
    return out.orderBy(F.desc("mean_abs"), F.asc("feature"))


def dependence(attributions: DataFrame, features: Sequence[str]) -> DataFrame:
    """Value against attribution for chosen features."""
    return attributions.where(F.col("feature").isin(list(features))).select("feature", "value", "phi")


# Local surrogate ---------------------------------------------------------------------------------------------

def _ridge(x: np.ndarray, y: np.ndarray, w: np.ndarray, alpha: float) -> np.ndarray:
    """Weighted ridge coefficients with an unpenalised intercept."""
    xm, ym = np.average(x, axis=0, weights=w), np.average(y, weights=w)
    xc, yc = x - xm, y - ym
    return np.linalg.solve((xc * w[:, None]).T @ xc + alpha * np.eye(x.shape[1]), (xc * w[:, None]).T @ yc)


def local_surrogate(cases: DataFrame, train: DataFrame, model: Transformer, features: Sequence[str], threshold: float,
                    samples: int = 5000, top: int = 10, key: str = "row_id", label: str = "label",
                    seed: int | str = 42, score: str | None = None) -> DataFrame:
    """Explain single rows: (row_index, true_label, pred_label, p_fraud, threshold, rank, term, weight).

    Around each case `samples` rows are drawn from the training quartile bins, scored in one transform,
    weighted by closeness, and fitted by a small ridge per case (a group holds exactly `samples` rows).
    """
    names = list(features)
    edges: dict[str, list[float]] = {f: [] for f in names}
    for r in quantiles(train, names, [0.0, 0.25, 0.5, 0.75, 1.0]).orderBy("prob").collect():
        edges[r["column"]].append(r["value"])  # five numbers per feature
    inner = {f: sorted(set(edges[f][1:4])) for f in names}
    ladder = {f: [edges[f][0], *inner[f], edges[f][4]] for f in names}
    cell = lambda f, c: sum(((c > F.lit(e)).cast("int") for e in inner[f]), F.lit(0))
    counted = train.agg(*[F.count(F.when(cell(f, F.col(f)) == i, 1)).alias(f"{f}__{i}")
                          for f in names for i in range(len(inner[f]) + 1)]).first()
    around = cases.select(F.col(key).alias("row_index"), F.col(label).cast("int").alias("true_label"),
                          *[F.col(f).cast("double").alias(f"x_{f}") for f in names],
                          F.explode(F.sequence(F.lit(0), F.lit(samples - 1))).alias("_s"))
    drawn, same = {}, {}
    for f in names:
        sizes = [counted[f"{f}__{i}"] for i in range(len(inner[f]) + 1)]
        steps = np.cumsum(sizes) / max(sum(sizes), 1)
        u = hash_unit("row_index", "_s", seed=f"{seed}-{f}-bin")
        pick = sum(((u >= F.lit(float(s))).cast("int") for s in steps[:-1]), F.lit(0))
        bounds = F.array(*[F.lit(float(v)) for v in ladder[f]])
        low, high = bounds[pick], bounds[pick + 1]
        inside = low + hash_unit("row_index", "_s", seed=f"{seed}-{f}-value") * (high - low)
        drawn[f] = F.when(F.col("_s") == 0, F.col(f"x_{f}")).otherwise(inside)
        same[f"z_{f}"] = F.when(F.col("_s") == 0, 1).otherwise((pick == cell(f, F.col(f"x_{f}"))).cast("int"))
    scored = model.transform(around.withColumns({**drawn, **same}))
    value = score or "_score"
    if value not in scored.columns:
        scored = positive_score(scored, value)
    table = scored.select("row_index", "true_label", "_s", F.col(value).alias("_y"), *[f"z_{f}" for f in names],
                          *[f"x_{f}" for f in names])
    width = 0.75 * np.sqrt(len(names))

    def term(f: str, x: float) -> str:
        i = sum(x > e for e in inner[f])
        if i == 0:
            return f"{f} <= {inner[f][0]:.2f}"
        if i == len(inner[f]):
            return f"{f} > {inner[f][-1]:.2f}"
        return f"{inner[f][i - 1]:.2f} < {f} <= {inner[f][i]:.2f}"

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_s")
        z = pdf[[f"z_{f}" for f in names]].to_numpy(dtype=float)
        y = pdf["_y"].to_numpy(dtype=float)
        w = np.sqrt(np.exp(-(1.0 - z).sum(axis=1) / width ** 2))
        rough = _ridge(z, y, w, 0.01) * z[0]
        kept = sorted(np.argsort(-np.abs(rough), kind="stable")[:top])
        coef = _ridge(z[:, kept], y, w, 1.0)
        order = sorted(range(len(kept)), key=lambda i: (-abs(coef[i]), i))
        first = pdf.iloc[0]
        return pd.DataFrame({
            "row_index": int(first["row_index"]), "true_label": int(first["true_label"]),
            "pred_label": int(y[0] >= threshold), "p_fraud": float(y[0]), "threshold": float(threshold),
            "rank": range(1, len(order) + 1), "term": [term(names[kept[i]], first[f"x_{names[kept[i]]}"]) for i in order],
            "weight": [float(coef[i]) for i in order]})

    return table.groupBy("row_index").applyInPandas(
        fit, "row_index bigint, true_label int, pred_label int, p_fraud double, threshold double, rank int, "
             "term string, weight double")


def cases_by_index(table: DataFrame, wanted: DataFrame, key: str = "row_id") -> DataFrame:
    """Rows named in a case list (`row_index`), list order kept in `position`."""
    return join_on(table, wanted.withColumnRenamed("row_index", key), [key])
