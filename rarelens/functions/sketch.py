"""A quantile sketch with a bound of relative error, as plain columns: counts per logarithmic bucket.

A positive value falls into bucket ceil(log(x) / log(g)) with g = (1 + error) / (1 - error); the bucket's middle is within
`error` of every value in it. Counts add up, so sketches merge by a sum, partial aggregation and streams included, and the
result does not depend on the order of rows. The number of buckets grows with the logarithm of the value range only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bucket of values that are not positive; its middle is 0.
ZERO = -(2 ** 31)


def _log_growth(error: float) -> float:
    if not 0 < error < 1:
        raise ValueError("the relative error lies between 0 and 1")
    return math.log((1 + error) / (1 - error))


def log_bucket(value: Column, error: float) -> Column:
    """The value's bucket; NULL for NULL and NaN."""
    x = value.cast("double")
    return F.when(F.isnan(x), F.lit(None)).when(x > 0, F.ceil(F.log(x) / F.lit(_log_growth(error))).cast("int")).when(x <= 0, F.lit(ZERO))


def bucket_middle(bucket: Column, error: float) -> Column:
    return F.when(bucket == ZERO, F.lit(0.0)).otherwise(F.exp(bucket * F.lit(_log_growth(error))) * F.lit(1 - error))


def sketch_quantile(buckets: Column, share: float, error: float) -> Column:
    """The quantile of a sorted array of struct(bucket, n): the middle of the bucket that holds position floor(share * (n - 1))."""
    total = F.aggregate(buckets, F.lit(0).cast("long"), lambda a, s: a + s["n"])
    at = F.floor(F.lit(float(share)) * (total - 1))
    found = F.aggregate(buckets, F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("int").alias("bucket")), lambda a, s: F.when(
        a["seen"] > at, a).otherwise(F.struct((a["seen"] + s["n"]).alias("seen"), s["bucket"].alias("bucket"))))
    return F.when(total > 0, bucket_middle(found["bucket"], error))
