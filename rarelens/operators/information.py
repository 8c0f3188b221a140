"""Nearest-neighbour mutual information between numeric features and a discrete target.

The estimate for a feature is psi(n) + mean psi(k) - mean psi(class size) - mean psi(m), not below 0, where m counts the
rows within the distance of a row's k-th neighbour of its own class (nearer than it; rows at the same value if that is 0).

Values are collapsed first, so a value that holds a third of the rows is one line. All features share the work, in range
buckets: neighbours of a class come from the `k` lines on either side, those at a bucket's rim from a small table of every
bucket's first and last `k` lines; the rows within a distance are differences of running totals, read at both ends by probes
that are sent to the end's bucket. No task holds more than a bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from rarelens.operators.ordered import join_on, long_values, running_totals, skew_split_join
from rarelens.session import materialize, ship_with_tasks

ship_with_tasks(__name__)

#: psi(x) = ln x - 1/2x - sum of these over x^2, x^4, ...: 1/12, -1/120, 1/252, -1/240, 1/132
_SERIES = (1 / 12, -1 / 120, 1 / 252, -1 / 240, 1 / 132)


def digamma(x: Column) -> Column:
    """Of values from 1, to about 13 digits: the series at x + 6, stepped down."""
    up = x + 6.0
    out = F.log(up) - 0.5 / up
    for i, c in enumerate(_SERIES, start=1):
        out = out - c / F.pow(up, F.lit(2.0 * i))
    for i in range(6):
        out = out - 1.0 / (x + float(i))
    return out


def neighbor_mutual_information(df: DataFrame, features: Sequence[str], target: str = "Class", k: int = 3, top: int | None = None) -> DataFrame:
    """(feature, mutual_information) in nats, largest first; missing values count as 0.

    Rows without a target, and rows whose class has no other row, take no part. Ties are taken as they are: no noise is added.
    """
    filled = df.where(F.col(target).isNotNull()).select(F.col(target).alias("_y"), *[
        F.coalesce(F.nanvl(F.col(f).cast("double"), F.lit(0.0)), F.lit(0.0)).alias(f) for f in features])
    classes = filled.groupBy("_y").agg(F.count("*").alias("_own_class")).where("_own_class > 1")
    classes = classes.crossJoin(F.broadcast(classes.agg(F.sum("_own_class").alias("_n"))))      # one line
    kept = skew_split_join(filled, classes, ["_y"], "_own_class", "_n")
    rows, plan = long_values(kept, features, ["_y", "_own_class", "_n"])
    points = materialize(rows.groupBy("column", "_bucket", "_y", F.col("_value").alias("v")).agg(
        F.count("*").alias("c"), F.max("_own_class").alias("_own_class"), F.max("_n").alias("_n")), "class-values")

    line = F.struct("v", "c")
    inside = Window.partitionBy("column", "_bucket", "_y")
    up, down = inside.orderBy("v"), inside.orderBy(F.desc("v"))
    rims = (points.select("column", "_bucket", "_y", line.alias("l"), F.row_number().over(up).alias("a"), F.row_number().over(down).alias("b"))
            .where((F.col("a") <= k) | (F.col("b") <= k)).groupBy("column", "_y", "_bucket").agg(
                F.collect_list(F.when(F.col("a") <= k, F.col("l"))).alias("first"), F.collect_list(F.when(F.col("b") <= k, F.col("l"))).alias("last")))
    buckets = Window.partitionBy("column", "_y").orderBy("_bucket")
    halo = rims.select("column", "_y", "_bucket",
                       F.array_sort(F.flatten(F.collect_list("last").over(buckets.rowsBetween(-k, -1)))).alias("_lower"),
                       F.array_sort(F.flatten(F.collect_list("first").over(buckets.rowsBetween(1, k)))).alias("_upper"))
    near = join_on(points, halo, ["column", "_bucket", "_y"])
    last = lambda a: F.slice(a, F.greatest(F.size(a) - k + 1, F.lit(1)), k)
    left = last(F.concat("_lower", F.array_sort(F.collect_list(line).over(up.rowsBetween(-k, -1)))))
    right = F.slice(F.concat(F.array_sort(F.collect_list(line).over(up.rowsBetween(1, k))), F.col("_upper")), 1, k)
    near = near.withColumn("left", left).withColumn("right", right).withColumn("k", F.least(F.lit(k).cast("long"), F.col("_own_class") - 1))
    ways = F.array_sort(F.concat(F.transform("left", lambda s: F.struct((F.col("v") - s["v"]).alias("d"), s["c"].alias("c"))),
                                 F.transform("right", lambda s: F.struct((s["v"] - F.col("v")).alias("d"), s["c"].alias("c")))))
    found = F.aggregate(ways, F.struct((F.col("c") - 1).alias("have"), F.lit(0.0).alias("r")), lambda acc, s: F.when(
        acc["have"] >= F.col("k"), acc).otherwise(F.struct((acc["have"] + s["c"]).alias("have"), s["d"].alias("r"))))
    reached = near.withColumn("r", found["r"])
    # the neighbour's own value, where it is at that distance, bounds the range without rounding
    low = F.coalesce(F.get(F.reverse(F.filter("left", lambda s: F.col("v") - s["v"] == F.col("r"))), F.lit(0))["v"], F.col("v") - F.col("r"))
    high = F.coalesce(F.get(F.filter("right", lambda s: s["v"] - F.col("v") == F.col("r")), F.lit(0))["v"], F.col("v") + F.col("r"))
    asked = materialize(reached.select("column", "_bucket", "_y", "v", "c", "k", "_own_class", "_n", "r", low.alias("low"), high.alias("high")), "ranges")

    edges = {c: np.array(e, float) for c, e in plan.edges.items()}

    @pandas_udf("int")
    def bucket_of(column: pd.Series, value: pd.Series) -> pd.Series:
        out = np.zeros(len(column), np.int32)
        for c in column.unique():
            own = (column == c).to_numpy()
            out[own] = np.searchsorted(edges[c], value.to_numpy()[own], "right")
        return pd.Series(out)

    # at one value: what is below it, its rows, what is up to it; a radius of 0 asks for its own rows
    ends = F.explode(F.array(F.struct(F.col("high").alias("at"), F.when(F.col("r") > 0, 0).otherwise(2).alias("tag"), F.lit(1).alias("sign")),
                             F.struct(F.col("low").alias("at"), F.when(F.col("r") > 0, 2).otherwise(0).alias("tag"), F.lit(-1).alias("sign"))))
    probes = asked.select("column", "_y", "v", ends.alias("e")).select("column", "_y", "v", "e.*")
    probes = probes.select("column", bucket_of("column", "at").alias("_bucket"), F.struct("at", "tag").alias("order"), F.lit(0).cast("long").alias("rows"), "_y", "v", "sign")
    values = points.groupBy("column", "_bucket", "v").agg(F.sum("c").alias("rows")).select(
        "column", "_bucket", F.struct(F.col("v").alias("at"), F.lit(1).alias("tag")).alias("order"), "rows",
        F.lit(None).cast(points.schema["_y"].dataType).alias("_y"), F.lit(None).cast("double").alias("v"), F.lit(None).cast("int").alias("sign"))
    totals = running_totals(values.unionByName(probes), ["column"], "_bucket", "order", ["rows"])
    within = totals.where("sign is not null").groupBy("column", "_y", "v").agg(F.sum(F.col("sign") * F.col("rows_upto")).alias("m"))
    joined = asked.join(within, ["column", "_y", "v"])
    psi = lambda c: digamma(F.col(c).cast("double"))
    parts = F.sum(F.col("c") * (psi("k") - psi("_own_class") - psi("m"))) / F.max("_n") + F.max(psi("_n"))
    out = joined.groupBy(F.col("column").alias("feature")).agg(F.greatest(parts, F.lit(0.0)).alias("mutual_information"))
    ordered = out.orderBy(F.desc("mutual_information"), "feature")
    return ordered.limit(top) if top else ordered
