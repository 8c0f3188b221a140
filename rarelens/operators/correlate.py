"""Correlation, covariance and mutual information."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from itertools import combinations_with_replacement

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rarelens.operators.ordered import distinct_ranks, quantiles, skew_split_join

PAIRS_PER_JOB = 240


def _pairs(df: DataFrame, columns: Sequence[str], measure: Callable[[str, str], Column]) -> DataFrame:
    """(column_a, column_b, value) for all a <= b from one aggregation per chunk of pairs."""
    pairs = list(combinations_with_replacement(columns, 2))
    parts = []
    # Chunks keep the generated aggregation code within the JVM's method size.
    for start in range(0, len(pairs), PAIRS_PER_JOB):
        items = [F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), measure(a, b).alias("value"))
                 for a, b in pairs[start:start + PAIRS_PER_JOB]]
        parts.append(df.agg(F.array(*items).alias("_i")).select(F.explode("_i").alias("_i")).select("_i.*"))
    return reduce(DataFrame.unionByName, parts)


def _centred(df: DataFrame, columns: Sequence[str]) -> DataFrame | None:
    """Columns shifted by their means, or None when a column has missing values."""
    row = df.agg(F.count(F.lit(1)), *[F.count(c) for c in columns], *[F.avg(c) for c in columns]).first()
    counts, means = row[1:1 + len(columns)], row[1 + len(columns):]
    if row[0] == 0 or any(c != row[0] for c in counts):
        return None
    return df.select(*[(F.col(c).cast("double") - F.lit(float(m))).alias(c) for c, m in zip(columns, means)])


def _moment(a: str, b: str) -> Column:
    """Sum of products about the mean, from plain sums of columns that are already near their mean."""
    return F.sum(F.col(a) * F.col(b)) - F.sum(a) * F.sum(b) / F.count(F.lit(1))


def _correlation(a: str, b: str) -> Column:
    scale = F.sqrt(_moment(a, a)) * F.sqrt(_moment(b, b))
    return F.lit(1.0) if a == b else F.try_divide(_moment(a, b), F.when(scale > 0, scale))


def pearson_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Lower triangle of the pairwise-complete Pearson matrix.

    Complete columns share their sums between pairs (one multiply-add per pair and row); columns with gaps need
    their own moments for each pair.
    """
    centred = _centred(df, columns)
    if centred is None:
        return _pairs(df, columns, lambda a, b: F.corr(a, b))
    return _pairs(centred, columns, _correlation)


def covariance_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Lower triangle of the pairwise-complete sample covariance matrix."""
    centred = _centred(df, columns)
    if centred is None:
        return _pairs(df, columns, lambda a, b: F.covar_samp(a, b))
    n = F.count(F.lit(1))
    return _pairs(centred, columns, lambda a, b: F.try_divide(_moment(a, b), F.when(n > 1, n - 1)))


def dense_pearson(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same triangle for many complete columns: one Gramian pass in Spark ML."""
    vectors = VectorAssembler(inputCols=list(columns), outputCol="_v", handleInvalid="error").transform(df)
    matrix = Correlation.corr(vectors.select("_v"), "_v", "pearson")
    name = matrix.columns[0]
    values = matrix.first()[name].toArray()  # columns x columns, not rows
    rows = [(a, b, float(values[i, j])) for i, a in enumerate(columns) for j, b in enumerate(columns) if i <= j]
    return df.sparkSession.createDataFrame(rows, "column_a string, column_b string, value double")


def correlation_with_target(df: DataFrame, features: Sequence[str], target: str = "Class",
                            top: int | None = None) -> DataFrame:
    """(feature, correlation) signed, strongest first."""
    items = [F.struct(F.lit(f).alias("feature"), F.corr(f, target).alias("correlation")) for f in features]
    out = df.agg(F.array(*items).alias("_i")).select(F.explode("_i").alias("_i")).select("_i.*")
    ordered = out.orderBy(F.desc(F.abs("correlation")), F.asc("feature"))
    return ordered.limit(top) if top else ordered


def ranked_rows(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """Long table (key, column, average_rank, n) for rows where every column is present.

    The rank of each distinct value is joined back on (column, value), frequent values apart from rare ones.
    """
    complete = df.select(key, *[F.nanvl(F.col(c).cast("double"), F.lit(None)).alias(c) for c in columns]).na.drop()
    items = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns])
    long = complete.select(key, F.explode(items).alias("_i")).select(key, "_i.column", "_i.value")
    ranks = distinct_ranks(complete, columns)
    return skew_split_join(long, ranks, ["column", "value"], "copies", "n").select(key, "column", "average_rank", "n")


def spearman_matrix(df: DataFrame, columns: Sequence[str], key: str) -> DataFrame:
    """Lower triangle of the Spearman matrix: Pearson of average ranks over complete rows.

    Ranks are centred on (n+1)/2, their mean whatever the values, so no extra pass is needed to find it.
    """
    centred = F.col("average_rank") - (F.col("n") + 1) / 2.0
    picks = [F.max(F.when(F.col("column") == c, centred)).alias(c) for c in columns]
    return _pairs(ranked_rows(df, columns, key).groupBy(key).agg(*picks), columns, _correlation)


def spearman_with_binary_target(df: DataFrame, features: Sequence[str], target: str = "Class") -> DataFrame:
    """Spearman of each feature with a 0/1 target without touching rows twice.

    Ranks of a two-valued target are a linear map of it, so the coefficient is the Pearson correlation of the
    feature's average rank with the target; both come from (value, copies, positives) sums.
    """
    r = distinct_ranks(df.where(F.col(target).isNotNull()), features, [target],
                       [F.sum(F.col(target).cast("double")).alias("pos")])
    c, pos = F.col("copies").cast("double"), F.col("pos")
    # Centred on the mean rank (n+1)/2, which is known in advance, to keep the sums well conditioned.
    d = F.col("average_rank") - (F.col("n") + 1) / 2.0
    variation = F.sum(pos) - F.sum(pos) * F.sum(pos) / F.sum(c)
    scale = F.sqrt(F.sum(c * d * d) * variation)
    return r.groupBy(F.col("column").alias("feature")).agg(
        F.try_divide(F.sum(pos * d), F.when(scale > 0, scale)).alias("correlation"))


def binned_mutual_information(df: DataFrame, features: Sequence[str], target: str = "Class", bins: int = 10,
                              top: int | None = None) -> DataFrame:
    """(feature, mutual_information) in nats, from exact quantile bins; missing values count as 0.

    A plug-in estimate over bins: it ranks features like a nearest-neighbour estimate but is not equal to it.
    """
    filled = df.select(F.col(target).alias("_y"), *[
        F.coalesce(F.nanvl(F.col(f).cast("double"), F.lit(0.0)), F.lit(0.0)).alias(f) for f in features])
    inner = [i / bins for i in range(1, bins)]
    edges = quantiles(filled, features, inner).groupBy("column").agg(
        F.array_sort(F.array_distinct(F.collect_list("value"))).alias("_edges"))
    # One row per feature with at most bins-1 edges: bounded by the schema, not by the data.
    items = F.array(*[F.struct(F.lit(f).alias("column"), F.col(f).alias("value")) for f in features])
    long = filled.select("_y", F.explode(items).alias("_i")).select("_y", "_i.*").join(F.broadcast(edges), "column")
    cell = F.size(F.filter("_edges", lambda e: e <= F.col("value")))
    joint = long.groupBy("column", cell.alias("_bin"), "_y").agg(F.count(F.lit(1)).alias("_c"))
    return mutual_information_from_counts(joint, top)


def mutual_information_from_counts(joint: DataFrame, top: int | None = None) -> DataFrame:
    """Mutual information from (column, _bin, _y, _c) contingency counts."""
    from pyspark.sql import Window
    over = lambda *keys: F.sum("_c").over(Window.partitionBy("column", *keys)).cast("double")
    n, nx, ny, c = over(), over("_bin"), over("_y"), F.col("_c").cast("double")
    term: Column = c / n * F.log(c * n / (nx * ny))
    out = joint.withColumn("_t", term).groupBy(F.col("column").alias("feature")).agg(
        F.sum("_t").alias("mutual_information"))
    ordered = out.orderBy(F.desc("mutual_information"), F.asc("feature"))
    return ordered.limit(top) if top else ordered


