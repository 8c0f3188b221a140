"""Exact k nearest neighbours (Euclidean) without pairing every point with every other.

Points are assigned to the nearest of a few pivots. The triangle inequality bounds how far a point's k-th
neighbour can be and which cells can hold it; a point is sent to those cells only. Inside a cell, points are
cut into blocks of fixed size, so no task holds more than one block of points and one block of queries and
none emits more than k rows per query. Exact copies are collapsed first: of any number of copies only the
smallest ids can ever be reported, so a third of all rows sharing one vector costs no more than one row.

Ties are ordered by id. Work per task is numpy on one block pair; Spark partitions, routes and merges.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rarelens.functions.features import stable_hash
from rarelens.operators.ordered import skew_split_join
from rarelens.session import materialize, ship_with_tasks

ship_with_tasks(__name__)

MAX_PIVOTS = 256
POINTS_PER_BLOCK = 4096
QUERIES_PER_BLOCK = 8192
SLACK = 1e-9


def _to_pivots(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances (rows x pivots), a few pivots at a time to bound memory."""
    out = np.empty((len(vectors), len(pivots)))
    for j, p in enumerate(pivots):
        out[:, j] = np.sqrt(((vectors - p) ** 2).sum(axis=1))
    return out


def _nearest(queries: np.ndarray, points: np.ndarray, point_ids: np.ndarray, k: int):
    """Row indices and squared distances of the k nearest points per query, ties by point id."""
    norms = (points ** 2).sum(axis=1)
    rows, cols, dist = [], [], []
    for start in range(0, len(queries), 256):
        q = queries[start:start + 256]
        rough = (q ** 2).sum(axis=1)[:, None] + norms[None, :] - 2.0 * (q @ points.T)
        at = min(k, len(points)) - 1
        reach = np.partition(rough, at, axis=1)[:, at]
        # The matrix form rounds differently from a difference; keep a margin, then measure the rest exactly.
        margin = SLACK * (1.0 + np.abs(rough).max(axis=1) + norms.max())
        of, near = np.nonzero(rough <= (reach + margin)[:, None])
        exact = ((points[near] - q[of]) ** 2).sum(axis=1)
        order = np.lexsort((point_ids[near], exact, of))
        of, near, exact = of[order], near[order], exact[order]
        first = np.searchsorted(of, np.arange(len(q)))
        keep = np.arange(len(of)) - first[of] < k
        rows.append(start + of[keep])
        cols.append(near[keep])
        dist.append(exact[keep])
    if not rows:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    return np.concatenate(rows), np.concatenate(cols), np.concatenate(dist)


def _first_per_group(df: DataFrame, by: str, order: list, limit: int) -> DataFrame:
    """Planned with a per-task group limit before the shuffle, so a hot group sends `limit` rows per task."""
    rank = F.row_number().over(Window.partitionBy(by).orderBy(*order))
    return df.withColumn("_rn", rank).where(F.col("_rn") <= limit)


def nearest_among_distinct(points: DataFrame, k: int, pivots: int | None = None,
                           points_per_block: int = POINTS_PER_BLOCK,
                           queries_per_block: int = QUERIES_PER_BLOCK) -> DataFrame:
    """(id, neighbor, squared_distance) of the k nearest distinct points, each point itself included."""
    spark = points.sparkSession
    total = points.count()
    if total == 0:
        return spark.createDataFrame([], "id bigint, neighbor bigint, squared_distance double")
    n_pivots = pivots or max(1, min(MAX_PIVOTS, int(math.sqrt(total) / 2)))
    chosen = points.orderBy(stable_hash("id", seed="pivot")).limit(n_pivots).select("v").collect()
    centers = np.array([r["v"] for r in chosen], dtype=float)

    def place(batches):
        for b in batches:
            v = np.array(b["v"].tolist(), dtype=float).reshape(len(b), -1)
            d = _to_pivots(v, centers)
            b["cell"] = d.argmin(axis=1)
            b["d"] = d.min(axis=1)
            yield b[["id", "v", "cell", "d"]]

    placed = materialize(points.select("id", "v").mapInPandas(place, "id bigint, v array<double>, cell int, d double"),
                         "neighbor-cells")
    counts = {r["cell"]: (r["n"], r["far"]) for r in
              placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("d").alias("far")).collect()}
    inner = _first_per_group(placed.select("cell", "d"), "cell", [F.col("d")], k)
    radius = {r["cell"]: r["r"] for r in inner.groupBy("cell").agg(
        F.max("d").alias("r"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= k).collect()}
    cells = np.array(sorted(counts))
    far = np.array([counts[c][1] for c in cells])
    reach = np.array([radius.get(c, np.inf) for c in cells])
    between = _to_pivots(centers[cells], centers[cells])
    used = centers[cells]

    def route(batches):
        for b in batches:
            v = np.array(b["v"].tolist(), dtype=float).reshape(len(b), -1)
            d = _to_pivots(v, used)
            bound = (d + reach[None, :]).min(axis=1) * (1 + SLACK) + SLACK
            own = np.searchsorted(cells, b["cell"].to_numpy())
            own_d = d[np.arange(len(b)), own]
            ball = d - far[None, :]
            gap = between[own]
            with np.errstate(divide="ignore", invalid="ignore"):
                plane = np.where(gap > 0, (d ** 2 - own_d[:, None] ** 2) / (2 * gap), 0.0)
            keep = np.maximum(ball, plane) <= bound[:, None] * (1 + SLACK) + SLACK
            q, c = np.nonzero(keep)
            yield pd.DataFrame({"id": b["id"].to_numpy()[q], "v": b["v"].to_numpy()[q], "cell": cells[c]})

    routed = placed.select("id", "v", "cell").mapInPandas(route, "id bigint, v array<double>, cell int")
    asked = {r["cell"]: r["n"] for r in routed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    split = lambda n, size: max(1, math.ceil(n / size))
    plan = [(int(c), split(counts[c][0], points_per_block), split(asked.get(c, 0), queries_per_block)) for c in cells]
    shape = spark.createDataFrame(plan, "cell int, pblocks int, qblocks int")  # one row per pivot
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    block = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    left = (routed.join(F.broadcast(shape), "cell").withColumn("qb", block("qblocks"))
            .select("id", "v", "cell", "qb", every("pblocks").alias("pb")))
    right = (placed.join(F.broadcast(shape), "cell").withColumn("pb", block("pblocks"))
             .select("id", "v", "cell", "pb", every("qblocks").alias("qb")))

    def search(queries: pd.DataFrame, data: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"id": pd.Series(dtype="int64"), "neighbor": pd.Series(dtype="int64"),
                              "squared_distance": pd.Series(dtype="float64")})
        if queries.empty or data.empty:
            return empty
        q = np.array(queries["v"].tolist(), dtype=float)
        p = np.array(data["v"].tolist(), dtype=float)
        ids = data["id"].to_numpy()
        rows, cols, dist = _nearest(q, p, ids, k)
        return pd.DataFrame({"id": queries["id"].to_numpy()[rows], "neighbor": ids[cols], "squared_distance": dist})

    keys = ["cell", "pb", "qb"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        search, "id bigint, neighbor bigint, squared_distance double")
    return _first_per_group(found, "id", [F.col("squared_distance"), F.col("neighbor")], k).drop("_rn")


def k_nearest(points: DataFrame, k: int = 5, **options) -> DataFrame:
    """(id, rank, neighbor, distance, neighbor_vector) for `points(id, v array<double>)`, self excluded."""
    points = points.select("id", "v")
    ranked = _first_per_group(points, "v", [F.col("id")], k + 1)
    members = ranked.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("members"))  # at most k+1 ids
    copies = points.groupBy("v").agg(F.count(F.lit(1)).alias("copies"))
    groups = materialize(members.join(copies, "v").withColumn("rep", F.col("members")[0]), "neighbor-groups")
    near = nearest_among_distinct(groups.select(F.col("rep").alias("id"), "v"), k + 1, **options)
    named = groups.select(F.col("rep").alias("neighbor"), "members", F.col("v").alias("neighbor_vector"))
    expanded = near.join(named, "neighbor").select(
        F.col("id").alias("rep"), "squared_distance", F.explode("members").alias("neighbor"), "neighbor_vector")
    listed = _first_per_group(expanded, "rep", [F.col("squared_distance"), F.col("neighbor")], k + 1)
    lists = listed.groupBy("rep").agg(F.array_sort(F.collect_list(F.struct(
        "squared_distance", "neighbor", "neighbor_vector"))).alias("near"))  # at most k+1 entries
    total = groups.agg(F.sum("copies")).scalar()
    per_vector = groups.join(lists, "rep").select("v", "near", "copies", total.alias("total"))
    rows = skew_split_join(points, per_vector, ["v"], "copies", "total").select(
        "id", F.posexplode(F.slice(F.filter("near", lambda n: n["neighbor"] != F.col("id")), 1, k)).alias("_p", "_n"))
    return rows.select("id", (F.col("_p") + 1).alias("rank"), F.col("_n.neighbor").alias("neighbor"),
                       F.sqrt("_n.squared_distance").alias("distance"), F.col("_n.neighbor_vector").alias("neighbor_vector"))
