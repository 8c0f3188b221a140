"""Stratified splits, folds, class weights and under-sampling without moving the table.

Rows are ordered inside their class by a seeded digest of the row key. A split is a set of cut points in that
order; the digest at each cut is found from prefix counts (`order_statistics`), and every row then learns its
split by comparing its own digest with a handful of literals. The table is neither sorted nor shuffled, no
class is gathered in one task, and per-class counts are exact.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rarelens.contracts import ContractError
from rarelens.functions.features import stable_hash
from rarelens.operators.ordered import hash_bucket, order_statistics

CLASS_LIMIT = 1000


def class_counts(df: DataFrame, label: str) -> dict:
    """Rows per class (a stratification label has few values; more than CLASS_LIMIT is refused)."""
    rows = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).limit(CLASS_LIMIT + 1).collect()
    if len(rows) > CLASS_LIMIT:
        raise ContractError(f"{label!r} has more than {CLASS_LIMIT} classes; not a stratification label")
    if any(r[label] is None for r in rows):
        raise ContractError(f"{label!r} has NULLs")
    return {r[label]: r["n"] for r in sorted(rows, key=lambda r: r[label])}


def proportional(counts: Mapping, size: int) -> dict:
    """Split `size` over classes in proportion to their counts; leftovers go to the largest remainders."""
    total = sum(counts.values())
    share = {c: size * n / total for c, n in counts.items()}
    base = {c: math.floor(s) for c, s in share.items()}
    left = size - sum(base.values())
    for c in sorted(share, key=lambda c: (-(share[c] - base[c]), str(c)))[:left]:
        base[c] += 1
    return base


def held_out_counts(counts: Mapping, fraction: float) -> dict:
    """Per-class size of a held-out part: ceil(fraction * n) rows in total, the rest kept proportionally."""
    total = sum(counts.values())
    kept = proportional(counts, total - math.ceil(fraction * total - 1e-9))
    return {c: n - kept[c] for c, n in counts.items()}


def _cut_digests(df: DataFrame, label: str, keys: Sequence[str], seed: int | str, cuts: Mapping) -> dict:
    """For each class and cut count k > 0: the k-th smallest digest."""
    wanted = {c: sorted({k for k in ks if k > 0}) for c, ks in cuts.items()}
    rows = df.select(F.col(label), stable_hash(*keys, seed=seed).alias("_hash")).withColumn(
        "_bucket", hash_bucket("_hash"))
    positions = F.array().cast("array<struct<tag:bigint,pos:bigint>>")
    for c, ks in wanted.items():
        here = F.array(*[F.struct(F.lit(k).cast("bigint").alias("tag"), F.lit(k - 1).cast("bigint").alias("pos"))
                         for k in ks]) if ks else positions
        positions = F.when(F.col(label) == F.lit(c), here).otherwise(positions)
    found = order_statistics(rows, [label], "_bucket", "_hash", lambda _: positions)
    return {(r[label], r["tag"]): r["value"] for r in found.collect()}  # classes x cuts rows


def assign_parts(df: DataFrame, label: str, keys: Sequence[str], parts: Sequence[tuple[str, Mapping]],
                 rest: str, output: str = "split", seed: int | str = 42) -> DataFrame:
    """Give the first parts[0] rows of each class (in digest order) to parts[0], and so on; others to `rest`.

    `keys` must identify rows: rows that share a key share a digest and cannot be separated.
    """
    ends: dict = {}
    cuts: dict = {}
    for name, sizes in parts:
        for c, n in sizes.items():
            ends[c] = ends.get(c, 0) + n
            cuts.setdefault(c, []).append((name, ends[c], n))
    digests = _cut_digests(df, label, keys, seed, {c: [end for _, end, _ in cs] for c, cs in cuts.items()})
    hashed = stable_hash(*keys, seed=seed)
    chosen: Column = F.lit(rest)
    for c, cs in cuts.items():
        inside: Column = F.lit(rest)
        for name, end, n in reversed(cs):
            if n > 0:
                inside = F.when(hashed <= F.lit(digests[(c, end)]), F.lit(name)).otherwise(inside)
        chosen = F.when(F.col(label) == F.lit(c), inside).otherwise(chosen)
    return df.withColumn(output, chosen)


def two_way_split(df: DataFrame, label: str, keys: Sequence[str], test_size: float = 0.2,
                  seed: int | str = 42) -> DataFrame:
    """Adds `split`: "test" for ceil(test_size * n) rows, stratified, else "train"."""
    sizes = held_out_counts(class_counts(df, label), test_size)
    return assign_parts(df, label, keys, [("test", sizes)], "train", seed=seed)


def three_way_split(df: DataFrame, label: str, keys: Sequence[str], test_size: float = 0.2, val_size: float = 0.1,
                    val_of: str = "all", seed: int | str = 42) -> DataFrame:
    """Test first, then validation from what is left.

    `val_of="all"` reads val_size as a fraction of the whole table, "rest" as a fraction of the non-test rows.
    """
    if val_of not in ("all", "rest"):
        raise ValueError("val_of must be 'all' or 'rest'")
    counts = class_counts(df, label)
    test = held_out_counts(counts, test_size)
    rest = {c: n - test[c] for c, n in counts.items()}
    fraction = val_size / (1.0 - test_size) if val_of == "all" else val_size
    val = held_out_counts(rest, fraction) if val_size > 0 else dict.fromkeys(counts, 0)
    return assign_parts(df, label, keys, [("test", test), ("val", val)], "train", seed=seed)


def k_folds(df: DataFrame, label: str, keys: Sequence[str], k: int = 5, output: str = "fold",
            seed: int | str = 42) -> DataFrame:
    """Adds a fold number 0..k-1; fold sizes differ by at most one inside every class."""
    counts = class_counts(df, label)
    sizes = [{c: n // k + (1 if i < n % k else 0) for c, n in counts.items()} for i in range(k)]
    named = assign_parts(df, label, keys, [(str(i), s) for i, s in enumerate(sizes[:-1])], str(k - 1), output, seed)
    return named.withColumn(output, F.col(output).cast("int"))


def undersample(df: DataFrame, label: str, keys: Sequence[str], majority_per_minority: float = 1.0,
                seed: int | str = 42) -> DataFrame:
    """Every class cut to at most ratio * (smallest class) rows; the smallest class stays whole."""
    counts = class_counts(df, label)
    limit = math.floor(min(counts.values()) * majority_per_minority)
    smallest = min(counts.values())
    keep = {c: n if n == smallest else min(n, limit) for c, n in counts.items()}
    marked = assign_parts(df, label, keys, [("keep", keep)], "drop", "_part", seed)
    return marked.where(F.col("_part") == "keep").drop("_part")


def split_audit(df: DataFrame, label: str, split: str = "split") -> DataFrame:
    """split + (row_count, positives, rate)."""
    return df.groupBy(split).agg(F.count(F.lit(1)).alias("row_count"), F.sum(label).cast("bigint").alias("positives"),
                                 F.round(F.avg(label), 6).alias("rate"))


def split_overlap(df: DataFrame, keys: Sequence[str], split: str = "split") -> DataFrame:
    """(shared_keys): keys that occur in more than one split; 0 for a sound split."""
    per_key = df.groupBy(*keys).agg(F.min(split).alias("_a"), F.max(split).alias("_b"))
    return per_key.agg(F.count(F.when(F.col("_a") != F.col("_b"), 1)).alias("shared_keys"))


def class_weight(df: DataFrame, label: str, mode: str | float | Mapping = "balanced") -> Column:
    """Weight column: "none", "balanced" n/(k n_c), "auto" (positives neg/pos), a positive weight or a mapping."""
    if mode == "none":
        return F.lit(1.0)
    if isinstance(mode, Mapping):
        weights = {c: float(w) for c, w in mode.items()}
    elif isinstance(mode, (int, float)):
        weights = {1: float(mode)}
    else:
        counts = class_counts(df, label)
        total = sum(counts.values())
        if mode in ("balanced", "balanced_subsample"):
            weights = {c: total / (len(counts) * n) for c, n in counts.items()}
        elif mode == "auto":
            weights = {1: counts.get(0, 0) / max(counts.get(1, 0), 1)}
        else:
            raise ValueError(f"unknown class weight mode {mode!r}")
    out: Column = F.lit(1.0)
    for c, w in weights.items():
        out = F.when(F.col(label) == F.lit(c), F.lit(w)).otherwise(out)
    return out
