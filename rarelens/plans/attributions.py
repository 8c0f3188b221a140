"""Exact Shapley attributions of tree ensembles, computed leaf by leaf in one pass over the rows.

A leaf is a list of conditions, one per feature on its path: an interval, a side for missing values, and the fraction of the
cover that its splits on that feature let through. A row meets some of a leaf's conditions; what the leaf adds to each
feature depends on that pattern alone, so it is worked out once per pattern that occurs in a batch.

- `path` attributions follow the cover: a feature that is not known goes both ways, weighted by the training cover.
- `background` attributions compare with rows of another table, all of them: the patterns of its rows are counted per leaf in one
  aggregation (at most 2 ** (features on the path) per leaf), and every pair of patterns has a closed form.

Both sum to the row's raw score (margin of boosted trees, class share of averaged ones) less `base`: the expected score under the
cover, or the mean score of the background. Features on no path get 0.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rarelens.operators.trees import Tree, matrix
from rarelens.plans.ensembles import Forest
from rarelens.session import ship_with_tasks

ship_with_tasks(__name__)


@dataclass
class Leaf:
    """Conditions of a path: low <= x < high (high may be infinite for "any value"), or missing if `missing` allows it."""

    value: float
    features: list[int]
    low: list[float]
    high: list[float]
    missing: list[bool]
    through: list[float]      # share of the cover that gets through this feature's splits
    known: list[bool]         # whether a value that is not missing can get through

    def met(self, x: np.ndarray) -> np.ndarray:
        """Rows by conditions."""
        out = np.empty((len(x), len(self.features)), bool)
        for j, f in enumerate(self.features):
            v = x[:, f]
            out[:, j] = np.where(np.isnan(v), self.missing[j], self.known[j] & (v >= self.low[j]) & ((v < self.high[j]) | np.isinf(self.high[j])))
        return out


def leaves_of(tree: Tree, scale: float) -> list[Leaf]:
    found = []

    def walk(node: int, conditions: dict[int, list]) -> None:
        if tree.left[node] < 0:
            found.append(Leaf(scale * tree.value[node], list(conditions), *([c[i] for c in conditions.values()] for i in range(5))))
            return
        f, t = tree.feature[node], tree.threshold[node]
        for child, left in ((tree.left[node], True), (tree.right[node], False)):
            low, high, missing, through, known = conditions.get(f, [-np.inf, np.inf, True, 1.0, True])
            share = tree.cover[child] / tree.cover[node] if tree.cover[node] > 0 else 0.5
            own = [low, min(high, t) if left else high, missing and tree.missing_left[node] == left, through * share, known]
            if not left:
                # beyond an infinite threshold there are only missing values
                own[0], own[4] = (max(low, t), known) if np.isfinite(t) else (low, False)
            walk(child, {**conditions, f: own})

    walk(0, {})
    return found


def forest_leaves(forest: Forest) -> list[Leaf]:
    scale = forest.rate if forest.kind == "boosted" else 1 / max(len(forest.trees), 1)
    return [leaf for t in forest.trees for leaf in leaves_of(t, scale)]


def _times(poly: np.ndarray, z: float, o: np.ndarray) -> np.ndarray:
    """Coefficients of poly * (z + o t), a row per pattern."""
    out = np.zeros((poly.shape[0], poly.shape[1] + 1))
    out[:, :-1] = poly * z
    out[:, 1:] += poly * o[:, None]
    return out


def _without(poly: np.ndarray, z: float, o: np.ndarray) -> np.ndarray:
    """poly / (z + o t) for factors with z > 0."""
    m = poly.shape[1] - 1
    met = np.zeros((poly.shape[0], m))
    for k in range(m, 0, -1):
        met[:, k - 1] = poly[:, k] - (z * met[:, k] if k < m else 0)
    return np.where(o[:, None] > 0, met, poly[:, :m] / z)


def path_contributions(leaf: Leaf, met: np.ndarray) -> np.ndarray:
    """What the leaf adds to each of its features, for patterns by conditions."""
    m = len(leaf.features)
    o = met.astype(float)
    poly = np.ones((len(o), 1))
    for j in range(m):
        poly = _times(poly, leaf.through[j], o[:, j])
    weight = np.array([1 / (m * comb(m - 1, k)) for k in range(m)])
    out = np.empty((len(o), m))
    for j in range(m):
        if leaf.through[j] > 0:
            rest = _without(poly, leaf.through[j], o[:, j])
        else:
            rest = np.ones((len(o), 1))
            for i in range(m):
                rest = _times(rest, leaf.through[i], o[:, i]) if i != j else rest
        out[:, j] = leaf.value * (o[:, j] - leaf.through[j]) * (rest @ weight)
    return out


def background_contributions(leaf: Leaf, met: np.ndarray, others: np.ndarray, share: np.ndarray) -> np.ndarray:
    """The same against background patterns with their shares of the background rows."""
    out = np.zeros(met.shape)
    for pattern, part in zip(others, share, strict=True):
        gained, lost = met & ~pattern, ~met & pattern
        reached = (met | pattern).all(1)
        a, b = gained.sum(1), lost.sum(1)
        n = a + b
        # of all orders of the n differing features, those in which this one completes (or breaks) the leaf's conditions
        for i in np.flatnonzero(reached & (n > 0)):
            if a[i]:
                out[i, gained[i]] += part * leaf.value / (a[i] * comb(int(n[i]), int(a[i])))
            if b[i]:
                out[i, lost[i]] -= part * leaf.value / (b[i] * comb(int(n[i]), int(b[i])))
    return out


def _codes(met: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct patterns, pattern of every row)."""
    packed = np.packbits(met, axis=1) if met.shape[1] else np.zeros((len(met), 1), np.uint8)
    _, first, back = np.unique(packed, axis=0, return_index=True, return_inverse=True)
    return met[first], back.reshape(-1)


def path_base(forest: Forest) -> float:
    """The expected raw score under the training cover."""
    base = forest.base_margin if forest.kind == "boosted" else 0.0
    return base + sum(leaf.value * float(np.prod(leaf.through)) for leaf in forest_leaves(forest))


def _vectors(df: DataFrame, features: Sequence[str]):
    return F.array(*[F.col(f).cast("double") for f in features]).alias("_x")


def background_patterns(background: DataFrame, forest: Forest, features: Sequence[str]) -> tuple[list[tuple[np.ndarray, np.ndarray]], float]:
    """Per leaf (patterns, shares) of all background rows, and their mean raw score."""
    leaves, width = forest_leaves(forest), len(features)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, bytes], int] = {}
        for batch in batches:
            x = matrix(batch.column(0), width)
            for i, leaf in enumerate(leaves):
                patterns, back = _codes(leaf.met(x))
                for p, n in zip(patterns, np.bincount(back, minlength=len(patterns)).tolist(), strict=True):
                    key = i, np.packbits(p).tobytes()
                    seen[key] = seen.get(key, 0) + n
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in seen], pa.int32()), pa.array([k[1] for k in seen], pa.binary()),
                                          pa.array(list(seen.values()), pa.int64())], names=["leaf", "pattern", "n"])

    counted = background.select(_vectors(background, features)).mapInArrow(run, "leaf int, pattern binary, n long")
    rows = counted.groupBy("leaf", "pattern").agg(F.sum("n").alias("n")).collect()
    out = []
    base = forest.base_margin if forest.kind == "boosted" else 0.0
    by_leaf: dict[int, list] = {}
    for r in rows:
        by_leaf.setdefault(r["leaf"], []).append(r)
    for i, leaf in enumerate(leaves):
        own = sorted(by_leaf.get(i, []), key=lambda r: bytes(r["pattern"]))
        m = len(leaf.features)
        patterns = np.array([np.unpackbits(np.frombuffer(bytes(r["pattern"]), np.uint8), count=m) if m else [] for r in own], bool).reshape(len(own), m)
        share = np.array([r["n"] for r in own], float)
        share = share / share.sum() if len(own) else share
        base += leaf.value * float(share[patterns.all(1)].sum()) if len(own) else 0.0
        out.append((patterns, share))
    return out, base


def tree_attributions(rows: DataFrame, forest: Forest, features: Sequence[str], key: str = "row_id", background: DataFrame | None = None) -> DataFrame:
    """(key, feature, value, phi, base) of every row and feature; against `background` if given, else along the paths."""
    leaves, names, width = forest_leaves(forest), list(features), len(features)
    patterns, base = background_patterns(background, forest, features) if background is not None else (None, path_base(forest))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("_x"), width)
            phi = np.zeros(x.shape)
            for i, leaf in enumerate(leaves):
                if not leaf.features:
                    continue
                distinct, back = _codes(leaf.met(x))
                each = path_contributions(leaf, distinct) if patterns is None else background_contributions(leaf, distinct, *patterns[i])
                phi[:, leaf.features] += each[back]
            at = pa.array(np.arange(len(x) + 1, dtype=np.int32) * width)
            yield pa.RecordBatch.from_arrays([batch.column(key), batch.column("_x"), pa.ListArray.from_arrays(at, pa.array(phi.ravel()))], names=[key, "_x", "_phi"])

    own = rows.select(key, _vectors(rows, features))
    kind = own.schema[key].dataType.simpleString()
    found = own.mapInArrow(run, f"`{key}` {kind}, _x array<double>, _phi array<double>")
    labels = F.array(*[F.lit(n) for n in names])
    return found.select(key, F.posexplode("_phi").alias("_i", "phi"), "_x").select(
        key, labels[F.col("_i")].alias("feature"), F.col("_x")[F.col("_i")].alias("value"), "phi", F.lit(base).alias("base"))
