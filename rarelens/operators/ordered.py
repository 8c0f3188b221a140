"""Exact ranks, running totals and order statistics without a single-task sort.

`Window.orderBy(x)` with no partition, and `percentile(x)`, both end in one task that holds every distinct
value. Here the value range is cut into buckets first. Bucket totals form a small table whose running sum gives
every bucket its offset, and the ordered work happens inside each bucket only.

The bucket edges are approximate quantiles, so a bucket gets an even share of rows however skewed the values
are; a value that holds a third of all rows is collapsed to one row by the group-by that comes first. Edges
only balance the work: any edges give the same, exact result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rarelens.session import shuffle_width

# Up to this many lines of some fifty bytes, a side table with a few lines per group may be broadcast.
BROADCAST_LINE_LIMIT = 500_000
# Edges come from about this many rows at least; a table that is estimated to hold fewer is read whole.
EDGE_SAMPLE = 1_000_000
# A bucket is planned to hold about this many rows of a large table.
BUCKET_ROWS = 4_000_000
HASH_PREFIX_DIGITS = 4


def double_array(values: Sequence[float]) -> Column:
    """An array literal in one expression (exact doubles; one call instead of one per element)."""
    return F.expr("array(" + ", ".join(f"{float(v)!r}D" for v in values) + ")")


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join that also matches NULL keys and keeps the left copy of each key."""
    renamed = right.select(*[F.col(c).alias(f"_right_{c}" if c in keys else c) for c in right.columns])
    condition = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    joined = left.join(renamed, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_right_{k}" for k in keys])


def skew_split_join(rows: DataFrame, side: DataFrame, keys: Sequence[str], copies: str, total: str,
                    share: int = 1000) -> DataFrame:
    """Inner join of rows with a table that has one line per key and the key's row count.

    Keys with more than 1/share of all rows (there are fewer than `share` of them) are joined by broadcast,
    so a key that holds a third of the rows never becomes one task. The others are joined by shuffle.
    """
    is_heavy = F.col(copies) * share > F.col(total)
    heavy, light = F.broadcast(side.where(is_heavy)), side.where(~is_heavy)
    frequent = join_on(rows, heavy, keys)
    rare = join_on(join_on(rows, heavy.select(*keys), keys, "left_anti"), light, keys)
    return frequent.unionByName(rare)


@dataclass(frozen=True)
class RangeBuckets:
    """Bucket edges per column, and an estimate of how many groups share them."""

    edges: dict[str, list[float]]
    groups: int

    def few_lines(self, per_group: int) -> bool:
        """Whether a table of `per_group` lines for every group and column is known to be small."""
        return self.groups * len(self.edges) * per_group <= BROADCAST_LINE_LIMIT

    def few_offsets(self, column: str) -> bool:
        return self.groups * (len(self.edges[column]) + 2) <= BROADCAST_LINE_LIMIT

    def apply(self, df: DataFrame, prefix: str = "_bucket_") -> DataFrame:
        """Add `<prefix><column>`: the number of edges at or below the value (binary search on the JVM)."""
        cut = {c: [float("-inf"), *[float(v) for v in e], float("inf")] for c, e in self.edges.items() if e}
        if cut:
            # all columns in one projection: a projection per column is analysed anew for each
            stage = Bucketizer(splitsArray=list(cut.values()), inputCols=list(cut), outputCols=[prefix + c for c in cut], handleInvalid="keep")
            df = stage.transform(df)
        return df.withColumns({prefix + c: F.coalesce(F.col(prefix + c).cast("int"), F.lit(-1)) if c in cut else F.lit(0) for c in self.edges})


def bucketize(df: DataFrame, column: str, edges: Sequence[float], output: str) -> DataFrame:
    if not edges:
        return df.withColumn(output, F.lit(0))
    splits = [float("-inf"), *[float(e) for e in edges], float("inf")]
    stage = Bucketizer(splits=splits, inputCol=column, outputCol=output, handleInvalid="keep")
    # Never NULL, so that joins on the bucket add no extra null filter above the scan.
    return stage.transform(df).withColumn(output, F.coalesce(F.col(output).cast("int"), F.lit(-1)))


def estimated_rows(df: DataFrame) -> float:
    """From the sizes of the files that the table comes from, which reads nothing; a table without files is counted.

    A join multiplies the optimizer's own estimate, so the sources' sum bounds it.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    sources = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    size = min(int(str(plan.stats().sizeInBytes())), sources)
    if size >= 1 << 60:
        return float(df.count())
    return size / (8 + sum(f.dataType.jsonValue() in ("string", "binary") and 20 or 8 for f in df.schema.fields))


def bucket_count(df: DataFrame) -> int:
    """Enough buckets for every reduce task, and more as the table grows."""
    grown = min(estimated_rows(df) / BUCKET_ROWS, 250_000)
    return int(max(min(4 * shuffle_width(df.sparkSession), 2048), 32, grown))


def range_buckets(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (),
                  buckets: int | None = None) -> RangeBuckets:
    """One column-pruned pass that sketches the quantiles of all columns from a sample of the rows.

    The sample is of bounded size, so the one task that merges the sketches gets no more from a larger table. Edges only
    balance the work: a poor sample makes uneven buckets, never a wrong result. Only the edges reach the driver.
    """
    n = buckets or bucket_count(df)
    probabilities = [i / n for i in range(1, n)]
    asked = double_array(probabilities)
    groups = F.approx_count_distinct(F.struct(*by)) if by else F.lit(1)
    share = max(EDGE_SAMPLE, 40 * n) / max(estimated_rows(df), 1.0)
    # groups are counted over all rows (a sketch of fixed size), in the same pass that sketches the sample's quantiles
    drawn = share < 1 and bool(by)
    # an aggregate takes no random expression, so rows are drawn in a projection below it
    sampled = df.withColumn("_drawn", F.rand(17) < share) if drawn else df.where(F.rand(17) < share) if share < 1 else df
    value = lambda c: F.when(F.col("_drawn"), F.col(c)) if drawn else F.col(c)
    sketches = [F.percentile_approx(value(c), asked, 10 * n).alias(f"e{i}") for i, c in enumerate(columns)]
    row = sampled.agg(*sketches, groups.alias("groups")).first()
    edges = {}
    for i, c in enumerate(columns):
        found = {float(v) for v in (row[f"e{i}"] or [])}
        edges[c] = sorted(v for v in found if abs(v) != float("inf") and v == v)
    return RangeBuckets(edges, int(row["groups"] or 0))


def running_totals(points: DataFrame, by: Sequence[str], bucket: str, order: str,
                   measures: Sequence[str], descending: bool = False, few_offsets: bool = False) -> DataFrame:
    """Add `<m>_upto` (inclusive running sum in `order`) and `<m>_total` for every measure.

    `points` holds one row per (by, order value). Offsets, one line per (by, bucket), are broadcast when their
    number is known to be small. Otherwise they are merged in by shuffle: join and window then use the same
    (by, bucket) partitioning, so the points are still shuffled once for both.
    """
    keys = [*by, bucket]
    direction = F.desc if descending else F.asc
    sums = points.groupBy(*keys).agg(*[F.sum(m).alias(f"_sum_{m}") for m in measures])
    over_buckets = Window.partitionBy(*by).orderBy(direction(bucket))
    earlier = over_buckets.rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *keys,
        *[F.coalesce(F.sum(f"_sum_{m}").over(earlier), F.lit(0)).alias(f"_offset_{m}") for m in measures],
        *[F.sum(f"_sum_{m}").over(Window.partitionBy(*by)).alias(f"{m}_total") for m in measures],
    )
    inside = Window.partitionBy(*keys).orderBy(direction(order)).rowsBetween(Window.unboundedPreceding, 0)
    joined = points.join(F.broadcast(offsets) if few_offsets else offsets.hint("merge"), keys)
    upto = {f"{m}_upto": F.col(f"_offset_{m}") + F.sum(m).over(inside) for m in measures}
    return joined.withColumns(upto).drop(*[f"_offset_{m}" for m in measures])


def order_statistics(rows: DataFrame, by: Sequence[str], bucket: str, value: str,
                     positions: Callable[[Column], Column], few_lines: bool = True) -> DataFrame:
    """The values at given 0-based positions of each group's sorted values.

    `positions(n)` maps a group's row count to an array of struct(tag, pos). Bucket counts locate the few
    buckets that hold a wanted position; only rows of those buckets are shuffled and ordered.
    Returns by + (tag, pos, n, value).
    """
    keys = [*by, bucket]
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    group = Window.partitionBy(*by)
    earlier = group.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    located = counts.select(
        *keys, "_rows",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_rows").over(group).alias("n"),
    )
    here = F.filter(positions(F.col("n")), lambda w: (w["pos"] >= F.col("_before"))
                    & (w["pos"] < F.col("_before") + F.col("_rows")))
    wanted = located.select(*keys, "_before", "n", F.explode(here).alias("_want")).select(
        *keys, "_before", "n", F.col("_want.tag").alias("tag"), F.col("_want.pos").alias("pos"))
    # Broadcast while the number of wanted positions of all groups is known to be small.
    bounded = F.broadcast if few_lines else (lambda d: d)
    near = join_on(rows, bounded(wanted.select(*keys).distinct()), keys, "left_semi")
    inside = Window.partitionBy(*keys).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    ranked = (near.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_copies"))
              .withColumn("_upto", F.sum("_copies").over(inside)))
    position = F.col("pos") - F.col("_before")
    hit = (position < F.col("_upto")) & (position >= F.col("_upto") - F.col("_copies"))
    return join_on(ranked, bounded(wanted), keys).where(hit).select(*by, "tag", "pos", "n", F.col(value).alias("value"))


def hash_bucket(hashed: Column | str) -> Column:
    """Bucket of a hex digest: its leading digits are already evenly spread."""
    return F.substring(hashed, 1, HASH_PREFIX_DIGITS)


def long_values(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (),
                by: Sequence[str] = ()) -> tuple[DataFrame, RangeBuckets]:
    """keep + (column, _bucket, _value) for every present value, and the buckets used (one pass for all columns)."""
    clean = df.select(*keep, *[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in columns])
    plan = range_buckets(clean, columns, by)
    items = [F.struct(F.lit(c).alias("column"), F.col(f"_bucket_{c}").alias("_bucket"), F.col(c).alias("_value"))
             for c in columns]
    rows = plan.apply(clean).select(*keep, F.explode(F.array(*items)).alias("_item")).select(*keep, "_item.*")
    return rows.where(F.col("_value").isNotNull()), plan


def quantiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float],
              by: Sequence[str] = ()) -> DataFrame:
    """Exact quantiles with linear interpolation, long form: by + (column, prob, n, value).

    NULL and NaN are skipped. A column with no values yields no rows.
    """
    rows, plan = long_values(df, columns, by, by)
    asked = double_array(sorted({float(p) for p in probabilities}))

    def positions(n: Column) -> Column:
        def side(name: str, rounded) -> Column:
            return F.transform(asked, lambda p: F.struct(
                F.struct(p.alias("prob"), F.lit(name).alias("side")).alias("tag"),
                rounded((n - 1) * p).cast("bigint").alias("pos")))
        return F.concat(side("low", F.floor), side("high", F.ceil))

    found = order_statistics(rows, [*by, "column"], "_bucket", "_value", positions, plan.few_lines(2 * len(probabilities)))
    low = F.max(F.when(F.col("tag.side") == "low", F.col("value")))
    high = F.max(F.when(F.col("tag.side") == "high", F.col("value")))
    at = (F.col("n") - 1) * F.col("prob")
    return (found.groupBy(*by, "column", F.col("tag.prob").alias("prob"), "n")
            .agg(low.alias("_low"), high.alias("_high"))
            .select(*by, "column", "prob", "n",
                    (F.col("_low") + (F.col("_high") - F.col("_low")) * (at - F.floor(at))).alias("value")))


def quantiles_wide(df: DataFrame, columns: Sequence[str], names: dict[str, float],
                   by: Sequence[str] = ()) -> DataFrame:
    """One row per (by, column) with a field per named probability."""
    long = quantiles(df, columns, list(names.values()), by)
    picks = [F.max(F.when(F.col("prob") == p, F.col("value"))).alias(name) for name, p in names.items()]
    return long.groupBy(*by, "column").agg(*picks)


def distinct_ranks(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = (),
                   extra: Sequence[Column] = ()) -> DataFrame:
    """Average rank of every distinct value of every column: (column, value, copies, average_rank, n, extras).

    `extra` aggregates over `keep` columns. All columns share one set of shuffles.
    """
    rows, plan = long_values(df, columns, keep)
    points = rows.groupBy("column", "_bucket", F.col("_value").alias("value")).agg(
        F.count(F.lit(1)).alias("copies"), *extra)
    few = all(plan.few_offsets(c) for c in columns)
    ranked = running_totals(points, ["column"], "_bucket", "value", ["copies"], few_offsets=few)
    average = F.col("copies_upto") - (F.col("copies") - 1) / 2.0
    return ranked.withColumn("average_rank", average).withColumnRenamed("copies_total", "n").drop(
        "_bucket", "copies_upto")
