"""Counts, moments, quantile profiles and the quality gate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rarelens.contracts import ContractError
from rarelens.operators.ingest import duplicate_counts
from rarelens.operators.ordered import join_on, quantiles, quantiles_wide

# Fixed values
DESCRIBE_QUANTILES = {"q01": 0.01, "q05": 0.05, "q25": 0.25, "q50": 0.50, "q75": 0.75, "q95": 0.95, "q99": 0.99}
WHISKER = 1.5


def basic_stats(df: DataFrame, target: str = "Class") -> DataFrame:
    """(total, positives, negatives, rate_percent) in one aggregation; the rate is 0 for an empty table."""
    total, pos = F.count(target), F.count(F.when(F.col(target) == 1, 1))
    rate = F.when(total == 0, F.lit(0.0)).otherwise(F.try_divide(pos * F.lit(100.0), total))
    return df.agg(total.alias("total"), pos.alias("positives"), (total - pos).alias("negatives"),
                  F.round(rate, 6).alias("rate_percent"))


def value_counts(df: DataFrame, column: str, keep_null: bool = False) -> DataFrame:
    """(value, count, share). The total is a scalar over the already grouped rows."""
    rows = df if keep_null else df.where(F.col(column).isNotNull())
    counts = rows.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn("share", F.col("count") / total)


def class_balance(df: DataFrame, target: str = "Class", positive: int | str = 1) -> DataFrame:
    """One row: ordered labels, counts, percents, fraud rate (%), majority:minority ratio, one positive per N."""
    number = F.col(target).try_cast("double")
    whole = (number == F.floor(number)) & (F.abs(number) < 2.0 ** 53)
    label = F.when(whole, number.cast("bigint").cast("string")).otherwise(F.col(target).cast("string"))
    counts = df.where(F.col(target).isNotNull()).groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("count"))
    # one entry per class: numbers by value, then text
    value = F.col("label").try_cast("double")
    pairs = F.array_sort(F.collect_list(F.struct(value.isNull().alias("text"), value.alias("value"), "label", "count")))
    total = F.sum("count")
    agg = counts.agg(
        pairs.alias("_pairs"), total.alias("total"), F.max("count").alias("_max"), F.min("count").alias("_min"),
        F.coalesce(F.sum(F.when(F.col("label") == str(positive), F.col("count"))), F.lit(0)).alias("_pos"))
    rate = F.when(F.col("total") > 0, F.try_divide(F.col("_pos") * F.lit(100.0), F.col("total"))).otherwise(F.lit(0.0))
    return agg.select(
        F.transform("_pairs", lambda p: p["label"]).alias("labels"),
        F.map_from_arrays(F.transform("_pairs", lambda p: p["label"]),
                          F.transform("_pairs", lambda p: p["count"])).alias("counts"),
        F.map_from_arrays(F.transform("_pairs", lambda p: p["label"]),
                          F.transform("_pairs", lambda p: p["count"] / F.col("total") * 100.0)).alias("percents"),
        F.coalesce("total", F.lit(0)).alias("total"), rate.alias("fraud_rate"),
        F.try_divide(F.col("_max").cast("double"), F.col("_min")).alias("majority_to_minority"),
        F.try_divide(F.lit(100.0), F.when(rate > 0, rate)).alias("one_positive_per_n"))


def group_summary(df: DataFrame, by: str, value: str) -> DataFrame:
    """count, mean, sum and exact median of a value per group."""
    moments = df.groupBy(by).agg(F.count(value).alias("count"), F.avg(value).alias("mean"), F.sum(value).alias("sum"))
    median = quantiles(df, [value], [0.5], [by]).select(by, F.col("value").alias("median"))
    return join_on(moments, median, [by], "left")


def rate_by(df: DataFrame, key: str, target: str = "Class") -> DataFrame:
    """key + (total, positives, rate)."""
    return df.groupBy(key).agg(
        F.count(target).alias("total"), F.sum(target).alias("positives"),
        F.round(F.avg(target), 6).alias("rate"))


def top_rates(rates: DataFrame, key: str, k: int = 3) -> DataFrame:
    """The k keys with the highest rate, lower key first on ties."""
    return rates.orderBy(F.desc("rate"), F.asc(key)).limit(k)


def mean_by(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.groupBy(key).agg(F.avg(value).alias("mean"), F.count(F.lit(1)).alias("count"))


# Shape -------------------------------------------------------------------------------------------------------

def sample_skewness(column: Column | str) -> Column:
    """Bias-corrected skewness; NULL below three values, 0 for a constant."""
    c = F.col(column) if isinstance(column, str) else column
    n = F.count(c).cast("double")
    factor = F.sqrt(n * (n - 1)) / F.when(n > 2, n - 2)
    constant = F.stddev_pop(c) == 0
    return F.when(n < 3, None).when(constant, 0.0).otherwise(F.skewness(c) * factor)


def sample_kurtosis(column: Column | str) -> Column:
    """Bias-corrected excess kurtosis; NULL below four values, 0 for a constant."""
    c = F.col(column) if isinstance(column, str) else column
    n = F.count(c).cast("double")
    factor = (n - 1) / F.when(n > 3, (n - 2) * (n - 3))
    constant = F.stddev_pop(c) == 0
    return F.when(n < 4, None).when(constant, 0.0).otherwise(factor * ((n + 1) * F.kurtosis(c) + 6))


def skew_label(skew: Column | str) -> Column:
    s = F.col(skew) if isinstance(skew, str) else skew
    return (F.when(s > 2, "heavy right skew").when(s > 1, "right skew").when(s < -1, "left skew")
            .when(s.isNotNull(), "approximately symmetric"))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: count, mean, std, min, max, skew, kurtosis, skew label and seven exact quantiles."""
    numbers = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in columns])
    blocks = [F.struct(
        F.lit(c).alias("column"), F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
        F.min(c).alias("min"), F.max(c).alias("max"), sample_skewness(c).alias("skew"),
        sample_kurtosis(c).alias("kurtosis")) for c in columns]
    moments = numbers.agg(F.array(*blocks).alias("_b")).select(F.explode("_b").alias("_b")).select("_b.*")
    shape = moments.withColumn("skew_label", skew_label("skew"))
    spread = quantiles_wide(numbers, columns, DESCRIBE_QUANTILES)
    return shape.join(spread, "column", "left")


def amount_profile(df: DataFrame, column: str = "Amount") -> DataFrame:
    """Profile of a messy numeric column: unparsable, NaN and infinite values are left out."""
    v = F.nanvl(F.col(column).try_cast("double"), F.lit(None))
    finite = df.select(F.when(F.abs(v) != F.lit(float("inf")), v).alias(column))
    kept = finite.where(F.col(column).isNotNull())
    out = describe(kept, [column]).drop("column", "skew_label")
    ratio = kept.agg(F.avg((F.col(column) >= 0).cast("double"))).scalar()
    return out.withColumns({"non_negative_ratio": ratio, "empty": F.col("count") == 0})


# Quality -----------------------------------------------------------------------------------------------------

def null_profile(df: DataFrame) -> DataFrame:
    """(column, nulls, null_ratio) for all columns from one pass."""
    floating = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    missing = lambda c: (F.col(c).isNull() | F.isnan(c)) if c in floating else F.col(c).isNull()
    counted = [F.struct(F.lit(c).alias("column"), F.count(F.when(missing(c), 1)).alias("nulls")) for c in df.columns]
    agg = df.agg(F.count(F.lit(1)).alias("_n"), F.array(*counted).alias("_c"))
    return agg.select("_n", F.explode("_c").alias("_c")).select(
        "_c.column", "_c.nulls",
        F.when(F.col("_n") > 0, F.try_divide(F.col("_c.nulls").cast("double"), F.col("_n"))).otherwise(F.lit(0.0))
        .alias("null_ratio"))


def top_null_ratios(df: DataFrame, k: int = 10) -> DataFrame:
    return null_profile(df).orderBy(F.desc("null_ratio"), F.asc("column")).limit(k)


def domain_violations(df: DataFrame, columns: Sequence[str] = ("Amount", "Time")) -> DataFrame:
    """(column, negatives) for the columns present."""
    present = [c for c in columns if c in df.columns]
    counted = [F.struct(F.lit(c).alias("column"), F.count(F.when(F.col(c) < 0, 1)).alias("negatives")) for c in present]
    return df.agg(F.array(*counted).alias("_c")).select(F.explode("_c").alias("_c")).select("_c.*")


def quality_gate(df: DataFrame, max_nulls: int = 0, max_duplicates: int = 0, allow_negative: bool = False,
                 amount: str = "Amount") -> DataFrame:
    """(rule, value, limit, passed), one row per rule."""
    nulls = null_profile(df).agg(F.sum("nulls").alias("value")).select(
        F.lit("nulls").alias("rule"), "value", F.lit(max_nulls).cast("bigint").alias("limit"))
    copies = duplicate_counts(df).select(
        F.lit("duplicates").alias("rule"), F.col("duplicate_rows").alias("value"),
        F.lit(max_duplicates).cast("bigint").alias("limit"))
    out = nulls.unionByName(copies)
    if amount in df.columns and not allow_negative:
        below = domain_violations(df, [amount]).select(
            F.lit("negative_amounts").alias("rule"), F.col("negatives").alias("value"),
            F.lit(0).cast("bigint").alias("limit"))
        out = out.unionByName(below)
    return out.withColumn("passed", F.col("value") <= F.col("limit"))


def enforce_gate(gate: DataFrame) -> None:
    """Raise when any rule failed (at most three rows are read)."""
    failed = [f"{r['rule']}={r['value']} (limit {r['limit']})" for r in gate.where(~F.col("passed")).collect()]
    if failed:
        raise ContractError("quality gate failed: " + ", ".join(failed))


def tail_share(df: DataFrame, column: str = "Amount", prob: float = 0.99) -> DataFrame:
    """(limit, share): the quantile and the share of rows strictly above it."""
    limit = quantiles(df, [column], [prob]).select("value").scalar()
    return df.agg(F.max(limit).alias("limit"), F.avg((F.col(column) > limit).cast("double")).alias("share"))


# Histograms and boxes ----------------------------------------------------------------------------------------

def _bounds(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.min(column).cast("double").alias("_lo"), F.max(column).cast("double").alias("_hi"),
                               F.count(column).alias("_n"))


def _finite(column: str) -> Column:
    """Present and neither NaN nor infinite."""
    return F.col(column).isNotNull() & (F.abs(F.col(column).cast("double")) < float("inf"))


def _cell(value: Column, low: Column, high: Column, bins: int) -> Column:
    """Equal-width cell; the last cell is closed, a constant column falls in the middle of a unit range."""
    flat = high == low
    lo, hi = F.when(flat, low - 0.5).otherwise(low), F.when(flat, high + 0.5).otherwise(high)
    return F.least(F.floor((value - lo) / (hi - lo) * bins), F.lit(bins - 1)).cast("int")


def histogram(df: DataFrame, column: str, bins: int, by: str | None = None, shared_range: bool = True) -> DataFrame:
    """[by] + (bin, left, right, count, density), empty bins included.

    With `by`, every class is normalised to area one; `shared_range` puts all classes on one axis,
    otherwise each class spans its own range.
    """
    keys = [by] if by else []
    clean = df.where(_finite(column))
    if by and not shared_range:
        stats = _bounds(clean, column, keys)
        rows = join_on(clean, F.broadcast(stats) if _few(clean, by) else stats, keys)
        low, high = F.col("_lo"), F.col("_hi")
        frame = stats
    else:
        ends = _bounds(clean, column).select(F.struct("_lo", "_hi").alias("_s")).scalar()
        low, high = ends["_lo"], ends["_hi"]
        rows = clean
        frame = _bounds(clean, column, keys).withColumns({"_lo": low, "_hi": high})
    counted = rows.groupBy(*keys, _cell(F.col(column), low, high, bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("count"))
    # Every bin of every class exists in the frame; counts are attached to it.
    frame = frame.where(F.col("_n") > 0).select(
        *keys, "_n", F.when(F.col("_hi") == F.col("_lo"), F.col("_lo") - 0.5).otherwise(F.col("_lo")).alias("_lo"),
        F.when(F.col("_hi") == F.col("_lo"), F.col("_hi") + 0.5).otherwise(F.col("_hi")).alias("_hi"),
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    joined = join_on(frame, counted, [*keys, "bin"], "left")
    count = F.coalesce(F.col("count"), F.lit(0))
    return joined.select(*keys, "bin", (F.col("_lo") + F.col("bin") * width).alias("left"),
                         (F.col("_lo") + (F.col("bin") + 1) * width).alias("right"), count.alias("count"),
                         (count / (F.col("_n") * width)).alias("density"))


def _few(df: DataFrame, by: str, limit: int = 10_000) -> bool:
    return df.agg(F.approx_count_distinct(by)).first()[0] <= limit


def hour_histogram(df: DataFrame, hour: str = "Hour") -> DataFrame:
    """Counts for all 24 hours, zeros included."""
    hours = df.sparkSession.range(24).select(F.col("id").cast("int").alias("hour"))
    counted = df.groupBy(F.col(hour).alias("hour")).agg(F.count(F.lit(1)).alias("count"))
    return hours.join(counted, "hour", "left").select(
        "hour", (F.col("hour") - 0.5).alias("left"), (F.col("hour") + 0.5).alias("right"),
        F.coalesce("count", F.lit(0)).alias("count"))


def box_summary(df: DataFrame, column: str, by: str) -> DataFrame:
    """Quartiles, 1.5 IQR whiskers (last data points inside the fences) and outlier count per class."""
    df = df.where(_finite(column))
    box = quantiles_wide(df, [column], {"q1": 0.25, "median": 0.5, "q3": 0.75}, [by]).drop("column")
    reach = (F.col("q3") - F.col("q1")) * WHISKER
    fenced = box.withColumns({"_low": F.col("q1") - reach, "_high": F.col("q3") + reach})
    rows = df.select(by, column)
    joined = join_on(rows, F.broadcast(fenced) if _few(df, by) else fenced, [by])
    v = F.col(column)
    inside = (v >= F.col("_low")) & (v <= F.col("_high"))
    return joined.groupBy(by, "q1", "median", "q3").agg(
        F.min(F.when(inside, v)).alias("whisker_low"), F.max(F.when(inside, v)).alias("whisker_high"),
        F.count(F.when(~inside, 1)).alias("outliers"), F.count(F.lit(1)).alias("count"))


# Top-k and run summaries -------------------------------------------------------------------------------------

def top_rows(df: DataFrame, column: str, tie_break: str, k: int = 5) -> DataFrame:
    """Top k rows; planned as TakeOrderedAndProject (each task keeps k rows, no full sort)."""
    return df.orderBy(F.desc(column), F.asc(tie_break)).limit(k)


def top_absolute(df: DataFrame, column: str, tie_break: str, k: int) -> DataFrame:
    return df.orderBy(F.desc(F.abs(F.col(column))), F.asc(tie_break)).limit(k)


def run_summary(results: DataFrame, metrics: Sequence[str], run: str = "run") -> DataFrame:
    """Mean and sample deviation of each metric per run."""
    out = [f(m).alias(f"{m}_{name}") for m in metrics for name, f in (("mean", F.avg), ("std", F.stddev_samp))]
    return results.groupBy(run).agg(*out)


def rank_results(results: DataFrame, metric: str = "mean_test_score", by: Sequence[str] = ()) -> DataFrame:
    """Competition rank of a result table (one row per parameter set, config-sized)."""
    return results.withColumn("rank", F.rank().over(Window.partitionBy(*by).orderBy(F.desc(metric))))


def column_reductions(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, sum, mean, std, min, max) with the population deviation."""
    blocks = [F.struct(F.lit(c).alias("column"), F.sum(c).cast("double").alias("sum"), F.avg(c).alias("mean"),
                       F.stddev_pop(c).alias("std"), F.min(c).cast("double").alias("min"),
                       F.max(c).cast("double").alias("max")) for c in columns]
    return df.agg(F.array(*blocks).alias("_b")).select(F.explode("_b").alias("_b")).select("_b.*")
