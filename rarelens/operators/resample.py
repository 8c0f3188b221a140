"""Synthetic minority over-sampling."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rarelens.contracts import ContractError
from rarelens.functions.features import hash_unit, stable_hash
from rarelens.operators.ingest import smallest_hash
from rarelens.operators.neighbors import k_nearest
from rarelens.operators.splits import class_counts


def smote(df: DataFrame, features: Sequence[str], target: str = "Class", key: str = "row_id", ratio: float = 0.05,
          k: int = 5, seed: int | str = 42, minority: int = 1, **options) -> DataFrame:
    """Synthetic minority rows (features + target + base, neighbor, gap) lifting it to ratio * majority.

    Each synthetic row lies between a minority row and one of its k nearest minority neighbours. How many a
    row spawns, which neighbour and how far are drawn from digests of its key, so reruns agree.
    """
    counts = class_counts(df, target)
    have = counts.get(minority, 0)
    wanted = math.floor(ratio * max(n for c, n in counts.items() if c != minority)) - have
    if wanted < 0:
        raise ContractError(f"the minority already exceeds {ratio:g} of the majority")
    if have <= k and wanted > 0:
        raise ContractError(f"{have} minority rows cannot have {k} neighbours each")
    few = df.where(F.col(target) == minority).select(
        F.col(key).cast("bigint").alias("id"), F.array(*[F.col(c).cast("double") for c in features]).alias("v"))
    each, extra = divmod(wanted, have) if have else (0, 0)
    hashed = few.withColumn("_hash", stable_hash("id", seed=f"{seed}-quota"))
    quota = F.lit(each)
    if extra:  # the rows with the `extra` smallest digests spawn one more
        quota = quota + (F.col("_hash") <= smallest_hash(hashed, extra)).cast("int")
    born = hashed.withColumn("_quota", quota).where(F.col("_quota") > 0).select(
        "id", "v", F.explode(F.sequence(F.lit(1), F.col("_quota"))).alias("draw"))
    born = born.withColumns({
        "rank": (F.floor(hash_unit("id", "draw", seed=f"{seed}-neighbor") * k) + 1).cast("int"),
        "gap": hash_unit("id", "draw", seed=f"{seed}-gap")})
    near = k_nearest(few, k, **options).select("id", "rank", "neighbor", "neighbor_vector")
    made = born.join(near, ["id", "rank"])
    point = F.zip_with("v", "neighbor_vector", lambda a, b: a + F.col("gap") * (b - a))
    return made.withColumn("_p", point).select(
        *[F.col("_p")[i].alias(c) for i, c in enumerate(features)], F.lit(minority).alias(target),
        F.col("id").alias("base"), "neighbor", "gap")


def oversample(df: DataFrame, features: Sequence[str], target: str = "Class", key: str = "row_id", **options) -> DataFrame:
    """Original and synthetic rows together (features + target), for training folds only."""
    made = smote(df, features, target, key, **options).select(*features, target)
    original = df.select(*[F.col(c).cast("double").alias(c) for c in features], F.col(target).cast("int").alias(target))
    return original.unionByName(made)
