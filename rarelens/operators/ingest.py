"""De-duplication, coercion, imputation, lookup and deterministic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rarelens.functions.features import stable_hash
from rarelens.operators.ordered import hash_bucket, order_statistics, quantiles

# Up to this many requested ids the request list is broadcast instead of shuffled with the table.
BROADCAST_ID_LIMIT = 1_000_000


def deduplicate(df: DataFrame) -> DataFrame:
    """Exact-row de-duplication; copies collapse map-side before the shuffle."""
    return df.dropDuplicates()


def duplicate_counts(df: DataFrame) -> DataFrame:
    """(row_count, distinct_rows, duplicate_rows): rows beyond the first copy."""
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    rows = F.coalesce(F.sum("_copies"), F.lit(0))
    return copies.agg(rows.alias("row_count"), F.count(F.lit(1)).alias("distinct_rows"),
                      (rows - F.count(F.lit(1))).alias("duplicate_rows"))


def binary_target(df: DataFrame, column: str, output: str = "Class") -> DataFrame:
    """Numeric targets pass; two text classes become 0/1 in sorted order; other text is cast or rejected.

    Row order carries no meaning in a distributed table, so classes are ordered by value.
    """
    if isinstance(df.schema[column].dataType, (T.NumericType, T.BooleanType)):
        number = F.col(column).cast("double")
        odd = number.isNotNull() & ~F.isnan(number) & (number != F.floor(number))
        value = F.when(~F.isnan(number), number.cast("int"))
        return df.withColumn(output, F.when(odd, F.raise_error(F.lit(f"{column} has values that are not classes")).cast("int")).otherwise(value))
    # Three values are enough to tell "exactly two" from "more".
    values = sorted(r[0] for r in df.select(column).where(F.col(column).isNotNull()).distinct().limit(3).collect())
    if len(values) == 2:
        return df.withColumn(output, F.when(F.col(column) == values[0], 0).when(F.col(column) == values[1], 1))
    number = F.col(column).try_cast("int")
    bad = F.col(column).isNotNull() & number.isNull()
    return df.withColumn(output, F.when(bad, F.raise_error(F.lit(f"{column} is not a binary target"))).otherwise(number))


def coerce_numeric(df: DataFrame, column: str, output: str | None = None) -> DataFrame:
    """Lossy cast to double: unparsable text and NaN become NULL."""
    return df.withColumn(output or column, F.nanvl(F.col(column).try_cast("double"), F.lit(None)))


def coercion_summary(df: DataFrame, column: str) -> DataFrame:
    """(kept, dropped, all_integral) of a lossy cast."""
    v = F.col("_number")
    return coerce_numeric(df, column, "_number").agg(
        F.count(v).alias("kept"), F.count(F.when(v.isNull(), 1)).alias("dropped"),
        F.coalesce(F.bool_and(F.when(v.isNotNull(), v == F.floor(v))), F.lit(True)).alias("all_integral"))


def drop_uncoercible(df: DataFrame, column: str) -> DataFrame:
    return coerce_numeric(df, column).where(F.col(column).isNotNull())


def non_finite_reasons(columns: Sequence[str]) -> Column:
    """Array of per-column reasons a row is unusable; empty when it is fine."""
    checks = []
    for c in columns:
        number = F.col(c).try_cast("double")
        checks.append(F.when(F.col(c).isNull(), F.lit(f"{c}: missing"))
                      .when(number.isNull(), F.lit(f"{c}: not numeric"))
                      .when(F.isnan(number), F.lit(f"{c}: NaN"))
                      .when(F.abs(number) == F.lit(float("inf")), F.lit(f"{c}: infinite")))
    return F.array_compact(F.array(*checks))


def reject_non_finite(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Strict form: reading a row with a non-finite feature raises with the reasons."""
    reasons = non_finite_reasons(columns)
    fail = F.raise_error(F.concat(F.lit("invalid input: "), F.array_join(reasons, "; "))).cast("boolean")
    return df.where(F.when(F.size(reasons) > 0, fail).otherwise(F.lit(True)))


def impute_median(df: DataFrame, column: str) -> DataFrame:
    """NULL/NaN replaced by the exact median, with `<column>_filled` marking the replaced rows."""
    value = F.nanvl(F.col(column).cast("double"), F.lit(None))
    median = quantiles(df, [column], [0.5]).select("value").scalar()
    return df.withColumns({f"{column}_filled": value.isNull(), column: F.coalesce(value, median)})


def fill_constant(df: DataFrame, columns: Sequence[str], value: float = 0.0) -> DataFrame:
    return df.na.fill(value, subset=list(columns))


def lookup(table: DataFrame, ids: DataFrame, key: str = "row_id") -> DataFrame:
    """Requested ids with their row and `status` ("found"/"not_found").

    A request list of checked size is broadcast to prune the table where it is scanned; a longer one is
    joined by shuffle.
    """
    small = ids.limit(BROADCAST_ID_LIMIT + 1).count() <= BROADCAST_ID_LIMIT
    wanted = table.join(F.broadcast(ids) if small else ids, key, "left_semi")
    marked = wanted.withColumn("_hit", F.lit(True))
    return ids.join(marked, key, "left").withColumn(
        "status", F.when(F.col("_hit"), F.lit("found")).otherwise(F.lit("not_found"))).drop("_hit")


def require_found(found: DataFrame, key: str = "row_id") -> DataFrame:
    """Strict lookup: an unmatched id raises."""
    fail = F.raise_error(F.concat(F.lit(f"{key} not found: "), F.col(key).cast("string"))).cast("boolean")
    return found.where(F.when(F.col("status") == "found", F.lit(True)).otherwise(fail)).drop("status")


def head(df: DataFrame, order: str, n: int = 5) -> DataFrame:
    return df.orderBy(F.asc(order)).limit(n)


def tail(df: DataFrame, order: str, n: int = 5) -> DataFrame:
    return df.orderBy(F.desc(order)).limit(n)


def slice_rows(df: DataFrame, order: str, start: int, stop: int) -> DataFrame:
    """Rows at positions start..stop-1 of the order (a small slice near the front)."""
    return df.orderBy(F.asc(order)).offset(start).limit(stop - start)


def sample_exact(df: DataFrame, keys: Sequence[str], n: int, seed: int | str = 42) -> DataFrame:
    """Exactly min(n, rows) rows without replacement, the same ones on every run.

    The n-th smallest row digest is found by counting digest prefixes; rows are then kept by comparing with
    it, so nothing is sorted or moved. Keys must identify rows.
    """
    if n <= 0:
        return df.limit(0)
    hashed = df.withColumn("_hash", stable_hash(*keys, seed=seed))
    cut = smallest_hash(hashed, n)
    return hashed.where(F.col("_hash") <= F.coalesce(cut, F.lit("g"))).drop("_hash")


def smallest_hash(hashed: DataFrame, n: int) -> Column:
    """The n-th smallest `_hash` as a scalar; NULL when there are fewer rows."""
    rows = hashed.select(hash_bucket("_hash").alias("_bucket"), "_hash")
    position = F.array(F.struct(F.lit("cut").alias("tag"), F.lit(n - 1).cast("bigint").alias("pos")))
    return order_statistics(rows, [], "_bucket", "_hash", lambda _: position).select("value").scalar()
