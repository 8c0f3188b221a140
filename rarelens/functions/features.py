"""Time and amount features as column expressions (all inside whole-stage codegen)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values
SECONDS_PER_DAY = 86400
SECONDS_PER_HOUR = 3600
NIGHT_START_HOUR = 0
NIGHT_END_HOUR = 6


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hour_of_day(seconds: Column | str) -> Column:
    """Hour 0..23; floor-modulo, so negative offsets wrap backwards as clock time does."""
    return F.floor(F.pmod(_col(seconds), F.lit(float(SECONDS_PER_DAY))) / SECONDS_PER_HOUR).cast("int")


def hours_since_start(seconds: Column | str) -> Column:
    return _col(seconds) / SECONDS_PER_HOUR


def hour_angle(hour: Column | str) -> Column:
    return F.lit(2.0 * math.pi) * _col(hour) / F.lit(24.0)


def hour_sin(hour: Column | str) -> Column:
    return F.sin(hour_angle(hour))


def hour_cos(hour: Column | str) -> Column:
    return F.cos(hour_angle(hour))


def night_flag(hour: Column | str) -> Column:
    h = _col(hour)
    return ((h >= NIGHT_START_HOUR) & (h < NIGHT_END_HOUR)).cast("int")


def log_amount(amount: Column | str, negatives: str = "clip") -> Column:
    """log(1 + amount). `negatives`: "clip" to zero, "reject" with an error, or "raw"."""
    a = _col(amount)
    if negatives == "clip":
        return F.log1p(F.greatest(a, F.lit(0.0)))
    if negatives == "reject":
        return F.when(a < 0, F.raise_error(F.lit("Amount must be non-negative"))).otherwise(F.log1p(a))
    if negatives == "raw":
        return F.log1p(a)
    raise ValueError(f"unknown handling of negative amounts: {negatives!r}")


def above(amount: Column | str, limit: Column | float) -> Column:
    """1 when strictly above the limit."""
    return (_col(amount) > limit).cast("int")


def bin_index(value: Column | str, edges: list[float] | list[Column]) -> Column:
    """Number of edges at or below the value: 0 .. len(edges)."""
    v = _col(value)
    total = F.lit(0)
    for edge in edges:
        total = total + (v >= edge).cast("int")
    return total


def z_score(value: Column | str, mean: Column | float, std: Column | float) -> Column:
    """Centred and scaled by the population deviation; a zero deviation only centres."""
    spread = std if isinstance(std, Column) else F.lit(float(std))
    return (_col(value) - mean) / F.when(spread == 0, F.lit(1.0)).otherwise(spread)


def min_max(value: Column | str, low: Column | float, high: Column | float) -> Column:
    """Rescale to 0..1; the small addend keeps a constant column finite."""
    low = low if isinstance(low, Column) else F.lit(float(low))
    high = high if isinstance(high, Column) else F.lit(float(high))
    return (_col(value) - low) / (high - low + F.lit(1e-12))


def decision_label(score: Column | str, threshold: Column | float,
                   positive: str = "fraud", negative: str = "legit") -> Column:
    """NULL for a score that is NULL or NaN."""
    known = _col(score).isNotNull() & ~F.isnan(_col(score))
    return F.when(known & (_col(score) >= threshold), F.lit(positive)).when(known, F.lit(negative))


def class_name(label: Column | str, names: dict[int, str] | None = None) -> Column:
    """Readable class name; labels outside the mapping become NULL."""
    names = names or {0: "Legit", 1: "Fraud"}
    out = F.lit(None).cast("string")
    for value, name in names.items():
        out = F.when(_col(label) == value, F.lit(name)).otherwise(out)
    return out


def stable_hash(*keys: Column | str, seed: int | str = 0) -> Column:
    """Seeded md5 of a row key: the same order on every engine, cluster size and retry."""
    return F.md5(F.concat_ws("|", *[F.coalesce(_col(k).cast("string"), F.lit("<null>")) for k in keys], F.lit(str(seed))))


def hash_unit(*keys: Column | str, seed: int | str = 0) -> Column:
    """A repeatable draw in [0, 1) taken from the row key instead of a random generator."""
    head = F.conv(F.substring(stable_hash(*keys, seed=seed), 1, 12), 16, 10).cast("double")
    return head / F.lit(float(16 ** 12))
