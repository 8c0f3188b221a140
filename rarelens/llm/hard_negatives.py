"""Hard negatives: for every anchor and each of its nearest rows of the same label, the best rows of other labels in a band.

Method: Kronecker-packed products. Components become integers, floor(scale * x), and are biased to be non-negative. Several
candidates' components are put side by side into fields of one wide integer, wide enough for a whole inner product; an anchor
component then multiplies all of them at once, and the exact scores are cut out of the sum and freed of the bias. A wide
integer is carried in the 53 exact bits of a double, so one matrix product does the work of several; where one field
would not fit (large components), it is a Python integer of any width.

All rows are candidates of all anchors, in blocks: a cell is a block of candidates and a group of anchors of one dimension, and
holds the group in memory while candidates pass in chunks. Anchors are sent to every block, candidates once per group of
4,096 anchors. The first scan, inside a label, finds the positives; the second, over all labels, finds the negatives in
the bands that the positives set. Only the best few of a cell leave it. Rows are dealt by a running number, so equal ids,
labels or vectors crowd nowhere.

Defined results: rows whose id, label or vector is null, whose vector is empty, or holds a null or non-finite component, take no
part, nor do those whose integer components have a squared length beyond 2**62 (scores would not fit a long). Vectors of other
dimensions are never compared. Repeated rows: each takes part as it stands, but rows of one id are never each other's
positive or negative; a repeated anchor repeats its results. An anchor without positives or a band without negatives has no
rows. Other columns, whatever their names, are not read; an empty table has no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rarelens.session import materialize, ship_with_tasks, shuffle_width

ship_with_tasks(__name__)

#: Anchors of a cell, and candidates of a block: at least where the cluster is wide enough, at most.
GROUP = 4096
BLOCK = (2048, 1 << 17)
#: Candidates multiplied at once; the first chunks are smaller, so later ones meet a bound.
CHUNK = (64, 2048)
#: Fields of a wide integer that doubles cannot carry.
WIDE_FIELDS = 16


class Packed:
    """Anchors against which chunks of candidates are multiplied."""

    def __init__(self, anchors: np.ndarray):
        self.bias = int(anchors.min())
        self.moved = anchors - self.bias
        self.sums = anchors.sum(1)

    def scores(self, candidates: np.ndarray) -> np.ndarray:
        """Exact inner products, anchors by candidates, as 64-bit integers."""
        bias, (n, dims) = int(candidates.min()), candidates.shape
        moved = candidates - bias
        width = max(1, (int(self.moved.max()) * int(moved.max()) * dims).bit_length())
        fields = 53 // width
        kind = np.float64 if fields else object
        fields = fields or WIDE_FIELDS
        short = -n % fields
        if short:
            moved = np.concatenate([moved, np.zeros((short, dims), moved.dtype)])
        wide = moved.reshape(-1, fields, dims).astype(object if kind is object else np.int64)
        wide = sum(wide[:, f] << (width * f) for f in range(fields)).astype(kind)
        product = self.moved.astype(kind) @ wide.T
        if kind is not object:
            product = product.astype(np.int64)
        mask = (1 << width) - 1
        raw = np.stack([(product >> (width * f)) & mask for f in range(fields)], axis=2).reshape(len(self.moved), -1)[:, :n]
        # sum (a + A)(b + B) less A sum b, B sum a and their product; A and B are the negated biases
        whole = object if kind is object else np.int64
        undo = self.bias * candidates.astype(whole).sum(1)[None, :] + bias * (self.sums.astype(whole)[:, None] - self.bias * dims)
        return (raw + undo).astype(np.int64)


class Best:
    """The best `k` (score, id) of every slot, fed with hits in any order."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.slot, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.bound = np.full(slots, np.iinfo(np.int64).min)

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        slot, score, ids = np.concatenate([self.slot, slot]), np.concatenate([self.score, score]), np.concatenate([self.id, ids])
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        first = np.searchsorted(slot, slot, "left")
        place = np.arange(len(slot)) - first
        keep = place < self.k
        self.slot, self.score, self.id = slot[keep], score[keep], ids[keep]
        full = place == self.k - 1
        self.bound[slot[full]] = score[full]


def _matrix(column: pa.Array, scale: int) -> np.ndarray:
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return np.floor(flat * scale).astype(np.int64).reshape(len(column), -1)


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, pa.RecordBatch]]:
    """(starts a cell, rows): slices of batches that hold one cell and one tag."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(c).to_numpy() for c in ("dim", "grp", "i", "j", "tag")]
        change = np.any([k[1:] != k[:-1] for k in keys], axis=0)
        edges = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            own = tuple(int(k[a]) for k in keys)
            yield last is None or own[:4] != last[:4], batch.slice(a, b - a)
            last = own


def _scanned(batches: Iterator[pa.RecordBatch], scale: int, begin, meet, end) -> Iterator[pa.RecordBatch]:
    """Runs cells: `begin(anchor batches)` makes a state, `meet` feeds it (scores, candidates), `end` gives its rows."""
    state, packed, anchors, seen = None, None, [], 0
    for starts, rows in _cells(batches):
        if starts:
            if state is not None:
                yield end(state)
            state, packed, anchors, seen = None, None, [], 0
        if rows.column("tag")[0].as_py() == 0:
            anchors.append(rows)
            continue
        if not anchors:
            continue
        if state is None:
            table = pa.Table.from_batches(anchors).combine_chunks().to_batches()[0]
            state, packed = begin(table), Packed(_matrix(table.column("v"), scale))
        vectors, at = _matrix(rows.column("v"), scale), 0
        while at < len(vectors):
            step = min(CHUNK[1], max(CHUNK[0], seen))
            meet(state, packed.scores(vectors[at:at + step]), rows.slice(at, step))
            at, seen = at + step, seen + step
    if state is not None:
        yield end(state)


def _numbers(rows: pa.RecordBatch, name: str) -> np.ndarray:
    return rows.column(name).to_numpy()


def _positives(k: int, scale: int):
    def begin(anchors):
        return anchors, _numbers(anchors, "id"), Best(anchors.num_rows, k)

    def meet(state, scores, rows):
        _, ids, best = state
        other = _numbers(rows, "id")
        a, c = np.nonzero((scores >= best.bound[:, None]) & (other[None, :] != ids[:, None]))
        best.add(a, scores[a, c], other[c])

    def end(state):
        anchors, _, best = state
        return pa.RecordBatch.from_arrays([pa.array(_numbers(anchors, "uid")[best.slot]), pa.array(best.score), pa.array(best.id)],
                                          names=["uid", "score", "id"])

    return lambda batches: _scanned(batches, scale, begin, meet, end)


def _negatives(k: int, scale: int, low: int, high: int):
    def begin(anchors):
        bands = anchors.column("bands")
        owner = np.repeat(np.arange(len(bands)), np.diff(bands.offsets.to_numpy()))
        values = bands.flatten()
        score = values.field("score").to_numpy()
        # low * positive <= 100 * negative <= high * positive, in whole numbers
        least = np.array([-(-low * int(s) // 100) for s in score], np.int64)
        most = np.array([min(high * int(s) // 100, 2 ** 63 - 1) for s in score], np.int64)
        widest = np.full(len(bands), np.iinfo(np.int64).min), np.full(len(bands), np.iinfo(np.int64).max)
        np.maximum.at(widest[0], owner, most)
        np.minimum.at(widest[1], owner, least)
        return {"anchors": anchors, "owner": owner, "least": least, "most": most, "first": bands.offsets.to_numpy()[:-1] - bands.offsets[0].as_py(),
                "n": np.diff(bands.offsets.to_numpy()), "widest": widest, "bands": values, "best": Best(len(owner), k)}

    def meet(state, scores, rows):
        best, first, n = state["best"], state["first"], state["n"]
        top, bottom = state["widest"]
        # the least score that any band of an anchor can still use
        floor = np.minimum.reduceat(np.maximum(state["least"], best.bound), first) if len(first) else bottom
        a, c = np.nonzero((scores >= floor[:, None]) & (scores <= top[:, None])
                          & (_numbers(rows, "label")[None, :] != _numbers(state["anchors"], "label")[:, None])
                          & (_numbers(rows, "id")[None, :] != _numbers(state["anchors"], "id")[:, None]))
        hit = scores[a, c]
        band = np.repeat(first[a], n[a]) + (np.arange(n[a].sum()) - np.repeat(np.cumsum(n[a]) - n[a], n[a]))
        c, hit = np.repeat(c, n[a]), np.repeat(hit, n[a])
        fits = (hit >= np.maximum(state["least"][band], best.bound[band])) & (hit <= state["most"][band])
        best.add(band[fits], hit[fits], _numbers(rows, "id")[c[fits]])

    def end(state):
        best, bands, owner = state["best"], state["bands"], state["owner"]
        of = lambda name: pa.array(bands.field(name).to_numpy()[best.slot])
        anchor = lambda name: pa.array(_numbers(state["anchors"], name)[owner[best.slot]])
        return pa.RecordBatch.from_arrays([anchor("uid"), anchor("id"), of("place"), of("id"), of("score"), pa.array(best.score), pa.array(best.id)],
                                          names=["uid", "anchor", "place", "positive", "positive_score", "score", "id"])

    return lambda batches: _scanned(batches, scale, begin, meet, end)


def _usable(rows: DataFrame, id_col: str, label: Column, vector_col: str, scale: int) -> DataFrame:
    """(id, label, dim, v) of the rows that take part."""
    kind = "array<float>" if rows.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"
    whole = lambda x: F.floor(x.cast("double") * scale).cast("double")
    # null, NaN and infinite components are not under the limit either
    squared = F.aggregate("v", F.lit(0.0), lambda s, x: s + F.when(F.abs(x.cast("double") * scale) < 2.0 ** 32, whole(x) * whole(x)).otherwise(2.0 ** 63))
    return (rows.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector_col).cast(kind).alias("v"))
            .where("id is not null and label is not null and size(v) > 0").where(squared <= 2.0 ** 62)
            .select("id", "label", F.size("v").alias("dim"), "v"))


def _cells_of(anchors: DataFrame, candidates: DataFrame, sizes: DataFrame) -> DataFrame:
    """Both sides dealt to the cells (i, j) of their key (dim, grp), anchors first; `sizes` has the key's groups and blocks."""
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n).cast("int") - 1))
    deal = lambda key, n: F.pmod(F.xxhash64(key), F.col(n)).cast("int")
    left = anchors.join(sizes, ["dim", "grp"]).withColumn("i", deal("uid", "groups")).withColumn("j", every("blocks"))
    right = (candidates.withColumn("uid", F.monotonically_increasing_id()).join(sizes, ["dim", "grp"])
             .withColumn("j", deal("uid", "blocks")).withColumn("i", every("groups")))
    keep = ["dim", "grp", "i", "j", "uid", "id", "label", "v"]
    both = left.select(*keep, "bands", F.lit(0).alias("tag")).unionByName(
        right.select(*keep, F.lit(None).cast(left.schema["bands"].dataType).alias("bands"), F.lit(1).alias("tag")))
    return both.repartition("dim", "grp", "i", "j").sortWithinPartitions("dim", "grp", "i", "j", "tag")


def mine(rows: DataFrame, anchors: Column, id_col: str = "vec_id", label: Column | str = "label", vector_col: str = "embedding", positives: int = 5,
         negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score), ranks from 1 for each anchor and positive.

    `anchors` chooses anchor rows by the columns `id` and `label`. A negative's score is `low` to `high` hundredths of the positive's.
    """
    spark = rows.sparkSession
    usable = _usable(rows, id_col, F.col(label) if isinstance(label, str) else label, vector_col, scale)
    bands = "array<struct<place:int,id:long,score:long>>"
    chosen = materialize(usable.where(anchors).withColumn("uid", F.monotonically_increasing_id()), "anchors")
    # the best are found per cell, so blocks are as large as they can be without leaving cores idle
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK[1]), F.least(F.ceil(F.col("n") / BLOCK[0]), F.lit(shuffle_width(spark)))).cast("long")
    counts = materialize(usable.groupBy("dim", "label").agg(F.count("*").alias("n"), F.count(F.when(anchors, 1)).alias("a"))
                         .select("dim", F.col("label").alias("grp"), "n", "a"), "sizes")
    layout = lambda c: c.where("a > 0").select("dim", "grp", F.ceil(F.col("a") / GROUP).alias("groups"), blocks.alias("blocks"))

    scan = _cells_of(chosen.withColumn("grp", F.col("label")).withColumn("bands", F.lit(None).cast(bands)), usable.withColumn("grp", F.col("label")), layout(counts))
    found = scan.mapInArrow(_positives(positives, scale), "uid long, score long, id long")
    first = Window.partitionBy("uid").orderBy(F.desc("score"), "id")
    best = found.withColumn("place", F.row_number().over(first)).where(F.col("place") <= positives)
    # at most `positives` entries per anchor
    best = best.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("place", "id", "score"))).alias("bands"))
    aimed = materialize(chosen.join(best.select("uid", F.col("bands").cast(bands).alias("bands")), "uid"), "aimed")

    every = F.lit(0).cast("long").alias("grp")
    all_sizes = counts.groupBy("dim", every).agg(F.sum("n").alias("n"), F.sum("a").alias("a"))
    scan = _cells_of(aimed.withColumn("grp", F.lit(0).cast("long")), usable.withColumn("grp", F.lit(0).cast("long")), layout(all_sizes))
    found = scan.mapInArrow(_negatives(negatives, scale, low, high),
                            "uid long, anchor long, place int, positive long, positive_score long, score long, id long")
    first = Window.partitionBy("uid", "place").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= negatives).select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
