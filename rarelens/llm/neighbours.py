"""Approximate nearest neighbours by cosine: inverted lists, scanned dimension block by dimension block.

Vectors are normalised and turned by a random orthogonal matrix, so that any few of their columns are a fair sample of the
distance. Each goes to the list of its nearest centroid. Inside a list all columns of a block are added up for the candidates
still in play, and a candidate is abandoned as soon as its partial distance is significantly beyond the query's k-th
distance so far: partial > (1 + eps / sqrt(d))^2 * d / D * bound. Survivors are scored by the exact cosine of the original
vectors in double precision.

A query's lists are visited in two rounds, so that the bound is tight where most of the work is: the nearest lists first,
in chunks of candidates that begin small and double, each with the bound of those before; then all others of its
lists at once, with the k-th distance that the first round found.

- Centroids come from at most `sample` vectors; every vector is indexed.
- Equal vectors are one candidate that keeps its k + 1 smallest ids, all that any query can return; equal queries are one.
- Lists are cut into blocks of about `block` vectors, so a hot list is many tasks; a query visits all blocks of its lists.
- A query probes `probe` of the lists, `first` of these in the first round, and further ones until they hold k + 1 vectors.
- `met` is the number of different vectors in a query's blocks, `added` the share of their components that was added up.

Defined results: vectors that are null, zero or hold nulls or non-finite components, and rows without an id, take no part;
ties go to the smaller id; fewer than k candidates are all returned; an empty table gives an empty result; repeated rows of
one id count once; other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rarelens.session import materialize, ship_with_tasks

ship_with_tasks(__name__)


@dataclass
class Index:
    turn: np.ndarray          # D x D, orthogonal
    centroids: np.ndarray     # lists x D, turned

    def turned(self, vectors: np.ndarray) -> np.ndarray:
        unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        return unit @ self.turn

    def nearest(self, turned: np.ndarray) -> np.ndarray:
        """Lists by distance, nearest first, for each row."""
        return np.argsort((self.centroids ** 2).sum(1) - 2 * turned @ self.centroids.T, axis=1, kind="stable")

    def home(self, turned: np.ndarray) -> np.ndarray:
        return np.argmin((self.centroids ** 2).sum(1) - 2 * turned @ self.centroids.T, axis=1)


def usable(vector: str) -> Column:
    v = F.col(vector)
    return (v.isNotNull() & (F.size(v) > 0) & F.exists(v, lambda x: x != 0)
            & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))


def _scaled(rows: np.ndarray) -> np.ndarray:
    """Rows divided by their largest component, so that squares neither overflow nor vanish."""
    return rows / np.abs(rows).max(axis=1, keepdims=True)


def fit(vectors: DataFrame, column: str, lists: int, sample: int = 20_000, seed: int = 7, rounds: int = 8) -> Index | None:
    """Centroids of at most `sample` of the vectors (those of the smallest digests of the vector)."""
    rows = vectors.select(column).orderBy(F.xxhash64(column)).limit(sample).toPandas()[column]
    if not len(rows):
        return None
    data = _scaled(np.stack([np.asarray(r, float) for r in rows]))
    rng = np.random.default_rng(seed)
    turn, _ = np.linalg.qr(rng.standard_normal((data.shape[1], data.shape[1])))
    index = Index(turn, np.zeros((0, data.shape[1])))
    points = index.turned(data)
    lists = max(1, min(lists, len(points)))
    index.centroids = points[rng.choice(len(points), lists, replace=False)]
    for _ in range(rounds):
        home = index.home(points)
        sums = np.zeros_like(index.centroids)
        np.add.at(sums, home, points)
        count = np.bincount(home, minlength=lists)
        index.centroids = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], index.centroids)
    return index


def scan(candidates: np.ndarray, query: np.ndarray, k: int, width: int, eps: float, bound: float = math.inf, chunk: int = 32) -> tuple[np.ndarray, int]:
    """Numbers of the candidates that were not abandoned, among them the k nearest within the bound with high probability,
    and how many components were added up.

    Chunks of candidates, each twice the last, are scanned one after the other, so that the bound of the first serves the rest.
    """
    n, dims = candidates.shape
    kept, near, added = [], np.zeros(0), 0
    begin, chunk = 0, chunk if math.isinf(bound) else 1024
    while begin < n:
        alive = np.arange(begin, min(begin + chunk, n))
        begin, chunk = begin + chunk, min(2 * chunk, 1024)
        partial = np.zeros(len(alive))
        closest = min(bound, np.partition(near, k - 1)[k - 1]) if len(near) >= k else bound
        for at in range(0, dims, width):
            piece = candidates[alive, at:at + width] - query[at:at + width]
            partial = partial + np.einsum("ij,ij->i", piece, piece)
            added += piece.size
            done = min(at + width, dims)
            limit = closest * (1 if done == dims else (1 + eps / math.sqrt(done)) ** 2 * done / dims) * (1 + 1e-9) + 1e-12
            stay = partial <= limit
            if not stay.all():
                alive, partial = alive[stay], partial[stay]
            if not len(alive):
                break
        if len(alive):
            kept.append(alive)
            near = np.concatenate([near, partial])
    kept = np.concatenate(kept) if kept else np.zeros(0, np.int64)
    return (kept[near <= np.partition(near, k - 1)[k - 1] + 1e-12] if len(near) > k else kept), added


def search(vectors: DataFrame, every: int, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", lists: int | None = None,
           probe: float = 0.65, first: float = 0.08, block: int = 4096, width: int = 8, eps: float = 2.1, sample: int = 20_000) -> DataFrame:
    """(query_id, rank, id, score, met, added): the k nearest other rows of each row whose id is divisible by `every`."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where(F.col("id").isNotNull() & usable("v"))
    rows = rows.select("id", "v", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(7), "v").alias("h2"), F.size("v").alias("dims"))
    key = ["h1", "h2"]
    rank = F.row_number().over(Window.partitionBy(*key).orderBy("id"))
    # map tasks keep k + 1 rows of a vector before the shuffle (a rank limit), so copies of a vector do not meet in one task
    few = rows.dropDuplicates(["id", *key]).withColumn("__r", rank).where(F.col("__r") <= k + 1)
    different = materialize(few.groupBy(*key).agg(F.first("v").alias("v"), F.first("dims").alias("dims"), F.sort_array(F.collect_list("id")).alias("ids")), "vectors")
    counts = different.groupBy("dims").count().collect()
    if len(counts) > 1:
        raise ValueError("vectors of several lengths")
    out = "query_id long, rank int, id long, score double, met long, added double"
    if not counts:
        return spark.createDataFrame([], out).withColumnRenamed("id", id_col)
    total, dims = counts[0]["count"], counts[0]["dims"]
    index = fit(different, "v", lists or max(1, min(math.isqrt(total), sample // 25)), sample)
    shared = spark.sparkContext.broadcast(index)

    @F.pandas_udf("int")
    def home(v: pd.Series) -> pd.Series:
        return pd.Series(shared.value.home(shared.value.turned(_scaled(np.stack(v)))) if len(v) else np.zeros(0, np.int64))

    placed = materialize(different.withColumn("list", home("v")), "lists")
    sizes = np.zeros(len(index.centroids), np.int64)
    for r in placed.groupBy("list").count().collect():      # one number per list
        sizes[r["list"]] = r["count"]
    blocks = np.maximum(1, -(-sizes // block))
    probes, nearest = (max(1, math.ceil(len(sizes) * part)) for part in (probe, min(first, probe)))

    @F.pandas_udf("array<array<int>>")
    def lists_of(v: pd.Series) -> pd.Series:
        """The lists of the first round and of the second."""
        if not len(v):
            return pd.Series([], dtype=object)
        order = shared.value.nearest(shared.value.turned(_scaled(np.stack(v))))
        enough = (np.cumsum(sizes[order], axis=1) < k + 1).sum(axis=1) + 1
        return pd.Series([[o[:max(nearest, e)].tolist(), o[max(nearest, e):probes].tolist()] for o, e in zip(order, enough, strict=True)])

    blocks_of = F.lit([int(b) for b in blocks])
    asked = rows.where(F.col("id") % every == 0).select("id", *key).distinct()
    queries = materialize(different.join(asked.select(*key).distinct(), key, "left_semi").select(*key, "v", lists_of("v").alias("lists")), "queries")
    members = placed.withColumn("blk", F.pmod("h2", F.get(blocks_of, F.col("list"))).cast("int"))
    none = F.lit(None)
    inf = F.lit(math.inf)

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        asks = group["ids"].isna().to_numpy()
        have, want = group[~asks].reset_index(drop=True), group[asks]
        got: dict[str, list] = {"h1": [], "h2": [], "id": [], "score": [], "met": [], "added": []}

        def line(*values: object) -> None:
            for name, value in zip(got, values, strict=True):
                got[name].append(value)

        if len(have) and len(want):
            raw, q_raw = np.stack(have["v"]), np.stack(want["v"])
            turned, q_turned = shared.value.turned(_scaled(raw)), shared.value.turned(_scaled(q_raw))
            ids = have["ids"].tolist()
            raw_norm = np.sqrt(np.einsum("ij,ij->i", raw, raw))
            for (a, b, bound), v, t in zip(want[["h1", "h2", "bound"]].itertuples(index=False), q_raw, q_turned, strict=True):
                near, added = scan(turned, t, k + 1, width, eps, bound)
                cosine = raw[near] @ v / (raw_norm[near] * math.sqrt(v @ v))
                line(a, b, 0, 0.0, len(have), added)          # the visit itself
                for n, s in zip(near.tolist(), cosine.tolist(), strict=True):
                    for i in ids[n]:
                        line(a, b, i, s, 0, 0)
        types = {"score": float}
        return pd.DataFrame({name: np.array(values, types.get(name, np.int64)) for name, values in got.items()})

    def visited(turn: int, bounds: DataFrame | None) -> DataFrame:
        asks = queries if bounds is None else queries.join(bounds, key, "left")
        visits = (asks.select(*key, "v", (inf if bounds is None else F.coalesce("bound", inf)).alias("bound"), F.explode(F.get("lists", F.lit(turn))).alias("list"))
                  .withColumn("blk", F.explode(F.sequence(F.lit(0), F.get(blocks_of, F.col("list")) - 1))))
        both = members.select("list", "blk", *key, "v", "ids", none.cast("double").alias("bound")).unionByName(
            visits.select("list", "blk", *key, "v", none.cast("array<long>").alias("ids"), "bound"))
        return materialize(both.groupBy("list", "blk").applyInPandas(compare, "h1 long, h2 long, id long, score double, met long, added long"), "visits")

    nearby = visited(0, None)
    scored = F.col("met") == 0
    worst = F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("score")))
    bounds = (nearby.where(scored).select(*key, "score", worst.alias("__r")).where(F.col("__r") <= k + 1).groupBy(*key)
              .agg(F.when(F.count("*") == k + 1, F.greatest(2 - 2 * F.min("score"), F.lit(0.0))).alias("bound")))
    visits = nearby.unionByName(visited(1, bounds))
    found = visits.where(scored)
    work = visits.where(~scored).groupBy(*key).agg(F.sum("met").alias("met"), (F.sum("added") / (F.sum("met") * dims)).alias("added"))
    best = F.row_number().over(Window.partitionBy(*key).orderBy(F.desc("score"), "id"))
    top = (found.withColumn("__r", best).where(F.col("__r") <= k + 1).groupBy(*key)
           .agg(F.sort_array(F.collect_list(F.struct(F.col("__r").alias("r"), "id", "score"))).alias("near")))
    others = F.filter("near", lambda n: n["id"] != F.col("query_id"))
    return (asked.select(F.col("id").alias("query_id"), *key).join(top, key).join(work, key)
            .select("query_id", "met", "added", F.posexplode(F.slice(others, 1, k)).alias("pos", "n"))
            .select("query_id", (F.col("pos") + 1).alias("rank"), F.col("n.id").alias(id_col), F.col("n.score").alias("score"), "met", "added"))

