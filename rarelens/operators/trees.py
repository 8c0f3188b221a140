"""Histogram growth of decision trees: any number of trees together, one scan of the table per level.

Rows are binned once (quantile edges, one byte per feature, 255 for a missing value) and written. A level is one job: a task
routes its rows through the trees grown so far, and adds up (first, second, rows) for every open node, feature and bin; one
exchange by (tree, node, feature) adds the tasks' sums and finds the best edge; the driver receives one line per open node. Sums
are integers (fixed point), so a tree does not depend on partitions, task order or cluster size.

A tree's rows are drawn from digests of the row's key: none, a share, or Poisson(1) copies (a bootstrap). `first` and `second`
are gradient and hessian for second-order trees, or the weights of both classes for gini and entropy trees. A node's
features may be drawn as well. Level-wise growth has no depth limit; open nodes are taken in groups of bounded memory.
Trees that draw the same rows share sums for as long as their splits are the same: nodes reached by one path hold the same
rows, so they are added up once, and each tree takes the edge that its own criterion and limits allow.

Missing values go to the side where they gain more (left if they make no difference). Values beyond the edges go to the
outer bins. Edges come from approximate quantiles; they are part of the result, and splits are `value < threshold`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import asdict, dataclass, field
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rarelens.session import materialize, ship_with_tasks

ship_with_tasks(__name__)

MISSING = 255
#: Sums of the open nodes of one scan take at most so many bytes in a task.
SCAN_BYTES = 64 << 20
#: Up to so many different lines of (first, second, copies), rows are counted by line instead of added up.
KINDS = 8
_U = np.uint64
#: Cumulative Poisson(1) probabilities.
_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(18)])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def unit_draws(keys: np.ndarray, seed: int) -> np.ndarray:
    """A number in [0, 1) per key."""
    salt = _mixed(np.array([seed & 0xFFFFFFFFFFFFFFFF], _U) + _U(0x9E3779B97F4A7C15))
    return (_mixed(keys.view(_U) ^ salt) >> _U(11)).astype(np.float64) * 2.0 ** -53


@dataclass(frozen=True)
class Growth:
    """How one tree is grown. `features` is a share, a number, "sqrt" or "log2" per node; `colsample` a share per tree."""

    criterion: str = "second_order"       # or "gini", "entropy"
    max_depth: int | None = 6
    min_split: int = 2                    # rows of a node that may be split
    min_leaf: int = 1                     # rows of a side
    min_child: float = 0.0                # hessian (or class weight) of a side
    reg_lambda: float = 1.0
    reg_alpha: float = 0.0
    gamma: float = 0.0                    # least gain
    max_delta_step: float = 0.0
    features: float | int | str = 1.0
    colsample: float = 1.0
    subsample: float = 1.0
    bootstrap: bool = False
    class_weight: str | tuple | None = None   # None, "balanced", "balanced_subsample" or (weight of 0, weight of 1)
    skip_fold: int | None = None          # rows of this fold are not learned from
    seed: int = 42

    def draw(self) -> tuple:
        """Trees with the same draw learn from the same rows with the same sums."""
        return self.criterion == "second_order", repr(self.class_weight), self.skip_fold, (self.bootstrap, self.subsample, self.seed) if self.bootstrap or self.subsample < 1 else None

    def choice(self) -> tuple:
        """Trees with the same choice take the same edge of the same sums."""
        return self.criterion, self.min_split, self.min_leaf, self.min_child, self.reg_lambda, self.reg_alpha, self.gamma, self.max_delta_step

    def copies(self, keys: np.ndarray) -> np.ndarray:
        """How often each row counts in this tree."""
        if self.bootstrap:
            return np.searchsorted(_POISSON, unit_draws(keys, self.seed), "right")
        if self.subsample < 1:
            return (unit_draws(keys, self.seed) < self.subsample).astype(np.int64)
        return np.ones(len(keys), np.int64)

    def node_features(self, total: int, node: int) -> np.ndarray:
        """Features that a node may split on."""
        ids = np.arange(total)
        if self.colsample < 1:
            ids = ids[np.argsort(unit_draws(ids.astype(np.int64), self.seed * 31 + 7), kind="stable")[:max(1, int(self.colsample * total))]]
        n = {"sqrt": math.isqrt(total), "log2": int(math.log2(total)) if total > 1 else 1}.get(self.features) if isinstance(self.features, str) else (
            self.features if isinstance(self.features, int) else int(round(self.features * total)))
        n = min(max(1, n), len(ids))
        if n < len(ids):
            ids = ids[np.argsort(unit_draws(ids.astype(np.int64) + np.int64((node + 1) << 20), self.seed * 31 + 11), kind="stable")[:n]]
        return np.sort(ids)


@dataclass
class Tree:
    """Nodes as parallel lists; node 0 is the root, `left` is -1 at leaves."""

    feature: list[int] = field(default_factory=lambda: [-1])
    edge: list[int] = field(default_factory=lambda: [-1])
    threshold: list[float] = field(default_factory=lambda: [0.0])
    missing_left: list[bool] = field(default_factory=lambda: [True])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])
    cover: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    rows: list[int] = field(default_factory=lambda: [0])
    depth: list[int] = field(default_factory=lambda: [0])

    def add(self, depth: int) -> int:
        for name, empty in (("feature", -1), ("edge", -1), ("threshold", 0.0), ("missing_left", True), ("left", -1), ("right", -1),
                            ("value", 0.0), ("cover", 0.0), ("gain", 0.0), ("rows", 0), ("depth", depth)):
            getattr(self, name).append(empty)
        return len(self.feature) - 1

    def _walk(self, n: int, goes_left) -> np.ndarray:
        left, right, feature = np.array(self.left), np.array(self.right), np.array(self.feature)
        node = np.zeros(n, np.int64)
        open_rows = np.arange(n) if left[0] >= 0 else np.zeros(0, np.int64)
        while len(open_rows):
            at = node[open_rows]
            node[open_rows] = np.where(goes_left(open_rows, at, feature[at]), left[at], right[at])
            open_rows = open_rows[left[node[open_rows]] >= 0]
        return node

    def leaf_of_bins(self, bins: np.ndarray) -> np.ndarray:
        edge, missing_left = np.array(self.edge), np.array(self.missing_left)

        def goes_left(rows, at, feature):
            b = bins[rows, feature]
            return np.where(b == MISSING, missing_left[at], b <= edge[at])
        return self._walk(len(bins), goes_left)

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        threshold, missing_left = np.array(self.threshold), np.array(self.missing_left)

        def goes_left(rows, at, feature):
            v = x[rows, feature]
            return np.where(np.isnan(v), missing_left[at], (v < threshold[at]) | np.isinf(threshold[at]))
        return self._walk(len(x), goes_left)

    def router(self) -> Tree:
        """Only what `leaf_of_bins` reads, as arrays."""
        return Tree(feature=np.array(self.feature, np.int32), edge=np.array(self.edge, np.int32), missing_left=np.array(self.missing_left),
                    left=np.array(self.left, np.int32), right=np.array(self.right, np.int32))

    def as_dict(self) -> dict:
        return asdict(self)


# Binning -------------------------------------------------------------------------------------------------------


def quantile_edges(df: DataFrame, features: Sequence[str], bins: int = 64, accuracy: int = 10_000) -> list[list[float]]:
    """Inner bin edges of each feature: distinct approximate quantiles, at most 253 of them. One aggregation."""
    if not 2 <= bins <= 254:
        raise ValueError("a bin number is one byte: 2 to 254 bins")
    shares = [i / bins for i in range(1, bins)]
    known = lambda f: F.when(~F.isnan(F.col(f).cast("double")), F.col(f).cast("double"))
    row = df.agg(*[F.percentile_approx(known(f), shares, accuracy).alias(f"q{i}") for i, f in enumerate(features)]).first()
    return [sorted(set(row[i] or [])) for i in range(len(features))]


def binned(df: DataFrame, features: Sequence[str], edges: Sequence[Sequence[float]], label: str, weight: str | None = None,
           key: str | None = None, keep: Mapping[str, str] | None = None) -> DataFrame:
    """Written table (key, label, weight, bins and the columns of `keep`, given as new name -> old name).

    Without a key rows are numbered as they are written. NULL and NaN are missing values.
    """
    keep = dict(keep or {})
    number = F.xxhash64(key) if key else F.monotonically_increasing_id()
    flat = df.select(number.alias("key"), F.col(label).cast("double").alias("label"), (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("weight"),
                     *[F.col(old).alias(new) for new, old in keep.items()], F.array(*[F.col(f).cast("double") for f in features]).alias("_x"))
    sorted_edges, width = [np.array(e, np.float64) for e in edges], len(edges)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("_x"), width)
            codes = np.empty(x.shape, np.uint8)
            for f, e in enumerate(sorted_edges):
                codes[:, f] = np.where(np.isnan(x[:, f]), MISSING, np.searchsorted(e, x[:, f], "right"))
            own = [batch.column(c) for c in batch.schema.names if c != "_x"]
            yield pa.RecordBatch.from_arrays([*own, byte_rows(codes)], names=[*[c for c in batch.schema.names if c != "_x"], "bins"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in flat.schema.fields if f.name != "_x")
    return materialize(flat.mapInArrow(run, f"{fields}, bins binary"), "binned")


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows by features from an array column; a null is NaN."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), width)


def byte_rows(codes: np.ndarray) -> pa.Array:
    """A binary column of one byte string per row."""
    n, width = codes.shape
    at = np.arange(n + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(at.tobytes()), pa.py_buffer(np.ascontiguousarray(codes).tobytes())])


def rows_of_bytes(column: pa.Array, width: int) -> np.ndarray:
    _, at, data = column.buffers()
    start = np.frombuffer(at, np.int32)[column.offset] if len(column) else 0
    return np.frombuffer(data, np.uint8)[start:start + len(column) * width].reshape(len(column), width) if len(column) else np.zeros((0, width), np.uint8)


# Growing -------------------------------------------------------------------------------------------------------


def _terms(growth: Growth, label: np.ndarray, weight: np.ndarray, margin: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """(first, second) of every row before draws."""
    if growth.criterion == "second_order":
        p = 1 / (1 + np.exp(-margin))
        return weight * (p - label), weight * np.maximum(p * (1 - p), 1e-16)
    return weight * (1 - label), weight * label


def _class_weighted(growth: Growth, weight: np.ndarray, label: np.ndarray, counts: np.ndarray | None) -> np.ndarray:
    """Row weights with class weights; `counts` are the (drawn) rows of both classes."""
    mode = growth.class_weight
    if mode is None:
        return weight
    pair = counts.sum() / (2 * np.maximum(counts, 1)) if isinstance(mode, str) else np.array(mode, float)
    return weight * np.where(label == 1, pair[1], pair[0])


def _drawn(growth: Growth, batch: pa.RecordBatch, counts: np.ndarray | None, shift: int):
    """(rows that count, copies, fixed-point first and second) of a batch for one tree."""
    keys, label = batch.column("key").to_numpy(), batch.column("label").to_numpy()
    copies = growth.copies(keys)
    if growth.skip_fold is not None:
        copies = np.where(batch.column("fold").to_numpy() == growth.skip_fold, 0, copies)
    rows = np.flatnonzero(copies)
    label, copies = label[rows], copies[rows]
    weight = _class_weighted(growth, batch.column("weight").to_numpy()[rows], label, counts)
    margin = batch.column("margin").to_numpy()[rows] if growth.criterion == "second_order" else None
    first, second = _terms(growth, label, weight, margin)
    fixed = lambda v: np.rint(np.ldexp(v, shift)).astype(np.int64) * copies
    return rows, copies.astype(np.int64), fixed(first), fixed(second)


def class_counts(table: DataFrame, growths: Sequence[Growth]) -> tuple[dict[int, np.ndarray], float]:
    """Rows of each class that every tree learns from (copies counted), and the sum of row weights. One scan."""
    needed = {t: g for t, g in enumerate(growths) if isinstance(g.class_weight, str)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, total = {t: np.zeros(2) for t in needed}, 0.0
        for batch in batches:
            label = batch.column("label").to_numpy() == 1
            total += float(batch.column("weight").to_numpy().sum())
            for t, g in needed.items():
                copies = g.copies(batch.column("key").to_numpy()) if g.class_weight == "balanced_subsample" else np.ones(len(label), np.int64)
                if g.skip_fold is not None:
                    copies = np.where(batch.column("fold").to_numpy() == g.skip_fold, 0, copies)
                seen[t] += [copies[~label].sum(), copies[label].sum()]
        rows = [(-1, total, 0.0), *[(t, *c) for t, c in seen.items()]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["tree", "zero", "one"])

    columns = [c for c in ("key", "label", "weight", "fold") if c in table.columns]
    found = table.select(*columns).mapInArrow(run, "tree long, zero double, one double").groupBy("tree").agg(F.sum("zero"), F.sum("one")).collect()
    counts = {r[0]: np.array([r[1], r[2]]) for r in found}
    total = float(counts.pop(-1, np.zeros(2))[0])
    return counts, total


def _objective(growth: Growth, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """What a side contributes to the gain."""
    if growth.criterion == "second_order":
        top = np.sign(first) * np.maximum(np.abs(first) - growth.reg_alpha, 0)
        if growth.max_delta_step:
            w = np.clip(-top / np.maximum(second + growth.reg_lambda, 1e-16), -growth.max_delta_step, growth.max_delta_step)
            return -(2 * first * w + (second + growth.reg_lambda) * w * w + 2 * growth.reg_alpha * np.abs(w))
        return top * top / np.maximum(second + growth.reg_lambda, 1e-16)
    total = np.maximum(first + second, 1e-300)
    if growth.criterion == "gini":
        return (first * first + second * second) / total
    if growth.criterion == "entropy":
        part = lambda v: np.where(v > 0, v * np.log2(np.maximum(v, 1e-300) / total), 0.0)
        return part(first) + part(second)
    raise ValueError(f"unknown criterion {growth.criterion!r}")


def leaf_value(growth: Growth, first: float, second: float) -> float:
    """The step of a second-order leaf, or the share of class 1."""
    if growth.criterion == "second_order":
        top = math.copysign(max(abs(first) - growth.reg_alpha, 0.0), first)
        step = -top / max(second + growth.reg_lambda, 1e-16)
        return max(-growth.max_delta_step, min(growth.max_delta_step, step)) if growth.max_delta_step else step
    return second / (first + second) if first + second > 0 else 0.0


def best_edge(growth: Growth, sums: np.ndarray, shift: int) -> tuple[float, int, bool, list[int], list[int]]:
    """(gain, edge, missing_left, left sums, all sums) of a feature's sums: one line per bin and the last for missing values.

    Without an edge that may be used the gain is -1.
    """
    inner, missing, total = sums[:-1], sums[-1], sums.sum(0)
    whole = np.cumsum(inner, 0)          # beyond the last edge only missing values are right
    best = (-1.0, -1, True, [0, 0, 0], total.tolist())
    if total[2] < growth.min_split:
        return best
    real = lambda v: np.ldexp(v.astype(np.float64), -shift)
    parent = _objective(growth, real(total[:1]), real(total[1:2]))[0]
    for missing_left in (True, False) if missing[2] else (True,):
        left = whole + missing if missing_left else whole
        right = total - left
        gain = _objective(growth, real(left[:, 0]), real(left[:, 1])) + _objective(growth, real(right[:, 0]), real(right[:, 1])) - parent
        size = lambda s: real(s[:, 1] if growth.criterion == "second_order" else s[:, 0] + s[:, 1])
        fits = (np.minimum(left[:, 2], right[:, 2]) >= max(growth.min_leaf, 1)) & (np.minimum(size(left), size(right)) >= growth.min_child) & (gain > 1e-9) & (gain >= growth.gamma)
        if fits.any():
            k = int(np.argmax(np.where(fits, gain, -np.inf)))
            if gain[k] > best[0]:
                best = (float(gain[k]), k, missing_left, left[k].tolist(), total.tolist())
    return best


def _kinds(first: np.ndarray, second: np.ndarray, copies: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """(distinct lines, line of each row) if the rows have few different values, as class weights and copies mostly do."""
    line, kinds = np.zeros(len(copies), np.int64), []
    rest = np.arange(len(copies))
    while len(rest):
        if len(kinds) == KINDS:
            return None
        i = rest[0]
        same = (first[rest] == first[i]) & (second[rest] == second[i]) & (copies[rest] == copies[i])
        line[rest[same]] = len(kinds)
        kinds.append((first[i], second[i], copies[i]))
        rest = rest[~same]
    return np.array(kinds, np.int64).reshape(-1, 3), line


def _sums(code: np.ndarray, cells: int, features: int, mine: np.ndarray, values: Sequence[np.ndarray], kinds: tuple[np.ndarray, np.ndarray] | None) -> np.ndarray:
    """(first, second, copies) of every cell, exact; `code` holds the cells of all rows feature by feature."""
    if kinds is not None:
        lines, line = kinds
        counted = np.bincount(code * len(lines) + np.tile(line[mine], features), minlength=cells * len(lines))
        return counted.reshape(cells, len(lines)) @ lines
    out = np.empty((cells, 3), np.int64)
    for i, v in enumerate(values):
        # bincount adds doubles: high and low halves keep integers exact
        low = np.bincount(code, np.tile(v[mine] & 0xFFFFFF, features), cells).astype(np.int64)
        high = np.bincount(code, np.tile(v[mine] >> 24, features), cells).astype(np.int64)
        out[:, i] = low + (high << 24)
    return out


def _scan(table: DataFrame, trees: list[Tree], growths: Sequence[Growth], leads: list[tuple[int, int, np.ndarray, list[int]]],
          edges: Sequence[Sequence[float]], counts: dict[int, np.ndarray], shift: int) -> dict[tuple[int, int, int], Any]:
    """The best split of every lead (tree, node, features, trees that choose by its sums), by (tree, node, choosing tree): one job."""
    width, bins = len(edges), max(len(e) for e in edges) + 1
    wanted: dict[int, dict[int, np.ndarray]] = {}
    for t, node, fs, _ in leads:
        wanted.setdefault(t, {})[node] = fs
    choosers = {(t, node): own for t, node, _, own in leads}
    growths = {t: growths[t] for t in {*wanted, *(c for own in choosers.values() for c in own)}}
    # trees of one draw one after the other: a batch's draw is held for them
    draws: dict[tuple, int] = {}
    wanted = dict(sorted(wanted.items(), key=lambda w: draws.setdefault(growths[w[0]].draw(), len(draws))))
    routers, counts = {t: trees[t].router() for t in wanted}, {t: counts[t] for t in wanted if t in counts}

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {(t, node): np.zeros((len(fs), bins + 1, 3), np.int64) for t, nodes in wanted.items() for node, fs in nodes.items()}
        for batch in batches:
            codes = rows_of_bytes(batch.column("bins"), width)
            drawn: tuple = (None,)
            for t, nodes in wanted.items():
                if drawn[0] != growths[t].draw():
                    rows, copies, first, second = _drawn(growths[t], batch, counts.get(t), shift)
                    kinds = None if growths[t].criterion == "second_order" else _kinds(first, second, copies)
                    drawn = growths[t].draw(), np.minimum(codes[rows], bins), codes[rows], (first, second, copies), kinds
                _, cells, own, values, kinds = drawn
                leaf = routers[t].leaf_of_bins(own)
                order = np.argsort(leaf, kind="stable")
                ends = np.searchsorted(leaf[order], np.arange(len(routers[t].left) + 1))
                for node, fs in nodes.items():
                    mine = order[ends[node]:ends[node + 1]]
                    if not len(mine):
                        continue
                    # one count over (feature, bin); missing values take the last bin
                    code = (cells[np.ix_(mine, fs)].astype(np.int64) + np.arange(len(fs)) * (bins + 1)).T.ravel()
                    sums[t, node] += _sums(code, len(fs) * (bins + 1), len(fs), mine, values, kinds).reshape(len(fs), bins + 1, 3)
        out = [(t, node, int(f), s.tobytes()) for (t, node), each in sums.items() for f, s in zip(wanted[t][node], each, strict=True) if each[0, :, 2].any()]
        yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.int32()),
                                          pa.array([o[2] for o in out], pa.int32()), pa.array([o[3] for o in out], pa.binary())],
                                         names=["tree", "node", "feature", "sums"])

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [("tree", pa.int32()), ("node", pa.int32()), ("chooser", pa.int32()), ("feature", pa.int32()), ("gain", pa.float64()), ("edge", pa.int32()), ("missing_left", pa.bool_()),
                 ("left", pa.list_(pa.int64())), ("total", pa.list_(pa.int64()))]

        def lines(key, sums):
            tree, node, feature = key
            for c in choosers[tree, node]:
                gain, edge, missing_left, left, total = best_edge(growths[c], sums, shift)
                yield dict(zip((k for k, _ in kinds), (tree, node, c, feature, gain, edge, missing_left, left, total), strict=True))
        key, held = None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                own = row["tree"], row["node"], row["feature"]
                sums = np.frombuffer(row["sums"], np.int64).reshape(bins + 1, 3)
                if own == key:
                    held = held + sums
                    continue
                if key is not None:
                    out += lines(key, held)
                key, held = own, sums
            if out:
                yield pa.RecordBatch.from_pylist(out, pa.schema(kinds))
        if key is not None:
            yield pa.RecordBatch.from_pylist(list(lines(key, held)), pa.schema(kinds))

    columns = [c for c in ("key", "label", "weight", "fold", "margin", "bins") if c in table.columns]
    partial = table.select(*columns).mapInArrow(add_up, "tree int, node int, feature int, sums binary")
    found = partial.repartition("tree", "node", "feature").sortWithinPartitions("tree", "node", "feature").mapInArrow(
        choose, "tree int, node int, chooser int, feature int, gain double, edge int, missing_left boolean, left array<bigint>, total array<bigint>")
    # of equal gains the lowest feature
    best = found.groupBy("tree", "node", "chooser").agg(F.max(F.struct("gain", (-F.col("feature")).alias("f"), "edge", "missing_left", "left", "total")).alias("b"))
    return {(r["tree"], r["node"], r["chooser"]): r["b"] for r in best.collect()}


def grow(table: DataFrame, growths: Sequence[Growth], edges: Sequence[Sequence[float]], total: float | None = None) -> list[Tree]:
    """One tree for each of `growths` from a table of `binned` (with a margin for second-order trees, a fold for `skip_fold`).

    `total` is the sum of the row weights, where the caller knows it and no class weights need counting.
    """
    counts: dict[int, np.ndarray] = {}
    if total is None or any(isinstance(g.class_weight, str) for g in growths):
        counts, total = class_counts(table, growths)
    # class weights at most double the total; 2 ** 60 is never reached, even if a bootstrap draws far more than it should
    heaviest = max([1.0, *[max(g.class_weight) for g in growths if isinstance(g.class_weight, tuple)]])
    shift = min(40, 60 - math.ceil(math.log2(8 * total * max(2.0, heaviest) + 2)))
    trees = [Tree() for _ in growths]
    open_nodes = [(t, 0) for t in range(len(growths))]
    bins = max(len(e) for e in edges) + 1 if edges else 1
    # equal paths hold the same rows
    paths: dict[tuple[int, int], tuple] = {(t, 0): growths[t].draw() for t, _ in open_nodes}
    while open_nodes and edges:
        number: dict[tuple, int] = {}
        leads: dict[tuple, tuple[int, int, np.ndarray, dict[tuple, int]]] = {}
        chosen = []
        for t, node in open_nodes:
            path, fs = number.setdefault(paths[t, node], len(number)), growths[t].node_features(len(edges), node)
            lead = leads.setdefault((path, fs.tobytes()), (t, node, fs, {}))
            chosen.append((t, node, path, (lead[0], lead[1], lead[3].setdefault(growths[t].choice(), t))))
        waiting = [(t, node, fs, list(own.values())) for t, node, fs, own in leads.values()]
        found, at = {}, 0
        while at < len(waiting):
            size, stop = 0, at
            while stop < len(waiting) and (stop == at or size <= SCAN_BYTES):
                size, stop = size + len(waiting[stop][2]) * (bins + 1) * 24, stop + 1
            found.update(_scan(table, trees, growths, waiting[at:stop], edges, counts, shift))
            at = stop
        paths, open_nodes = {}, []
        for t, node, path, place in chosen:
            r = found.get(place)
            for left, child in enumerate(_applied(trees[t], growths[t], node, r, edges, shift) if r is not None else ()):
                if growths[t].max_depth is not None and trees[t].depth[child] >= growths[t].max_depth:
                    continue
                if trees[t].rows[child] >= max(growths[t].min_split, 2 * growths[t].min_leaf):
                    paths[t, child] = path, r["f"], r["edge"], r["missing_left"], left
                    open_nodes.append((t, child))
    return trees


def _applied(tree: Tree, growth: Growth, node: int, r, edges: Sequence[Sequence[float]], shift: int) -> tuple:
    """Fill in a node from its best split; its children if it has one."""
    real = lambda v: math.ldexp(v, -shift)

    def fill(n: int, sums: Sequence[int]) -> None:
        first, second = real(sums[0]), real(sums[1])
        tree.value[n], tree.rows[n] = leaf_value(growth, first, second), int(sums[2])
        tree.cover[n] = second if growth.criterion == "second_order" else first + second
    fill(node, r["total"])
    if r["gain"] < 0 or tree.depth[node] == growth.max_depth:     # a root is scanned for its sums at any depth
        return ()
    feature = -r["f"]
    inner = edges[feature]
    tree.feature[node], tree.edge[node] = feature, r["edge"]
    tree.threshold[node] = float(inner[r["edge"]]) if r["edge"] < len(inner) else math.inf
    tree.missing_left[node], tree.gain[node] = r["missing_left"], r["gain"]
    children = tree.add(tree.depth[node] + 1), tree.add(tree.depth[node] + 1)
    fill(children[0], r["left"])
    fill(children[1], [a - b for a, b in zip(r["total"], r["left"], strict=True)])
    tree.left[node], tree.right[node] = children
    return children


def leaf_values(trees: Sequence[Tree], codes: np.ndarray) -> np.ndarray:
    """Rows by trees, from bins."""
    return np.stack([np.array(t.value)[t.leaf_of_bins(codes)] for t in trees], 1) if trees else np.zeros((len(codes), 0))
