"""Query registry and the SQL fragments shared by the oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without `sql` it is checked on small fixtures in tests/ instead."""
    def register(run: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name!r} is already registered")
        _QUERIES[name] = run
        if sql is not None:
            _ORACLES[name] = sql
        return run
    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    return dict(_ORACLES)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """All floating columns rounded, so results compare across engines."""
    return df.select(*[
        F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType))
        else F.col(f.name) for f in df.schema.fields])


def double_list(values) -> str:
    return "[" + ", ".join(f"{float(v)!r}::DOUBLE" for v in values) + "]"


# SQL views of the sample tables (the counterparts of sources.tables)
TX = """tx AS (
  SELECT event_id AS row_id, ts, user_id,
         (epoch_us(ts) - (SELECT min(epoch_us(ts)) FROM events)) / 1e6::DOUBLE AS "Time",
         value AS "Amount", CAST(event_type = 'error' AS INTEGER) AS "Class" FROM events)"""
HOUR = """CAST(floor((((("Time" % 86400) + 86400) % 86400)) / 3600) AS INTEGER)"""
TXH = TX + f""", txh AS (
  SELECT *, {HOUR} AS "Hour", sin(2*pi()*{HOUR}/24.0::DOUBLE) AS hour_sin, cos(2*pi()*{HOUR}/24.0::DOUBLE) AS hour_cos,
         ln(1 + greatest("Amount", 0)) AS "Amount_log1p" FROM tx)"""


def _scored(name: str, code: str, base: int) -> str:
    return f"""{name} AS (
  SELECT l_orderkey, l_linenumber, CAST(l_returnflag = 'R' AS INTEGER) AS label,
         (({code}) % {base}) / {base}.0::DOUBLE * 0.7::DOUBLE
         + CASE WHEN l_returnflag = 'R' THEN 0.2::DOUBLE ELSE 0.0::DOUBLE END AS score FROM lineitem)"""


SC = _scored("sc", "l_orderkey * 7919 + l_linenumber * 104729", 1009)
SF = _scored("sf", "l_orderkey * 69069069 + l_linenumber::BIGINT * 1299709", 2147483647)
MODELS = SC + ", " + SF + """, models AS (
  SELECT 'coarse' AS model, label, score FROM sc UNION ALL SELECT 'fine' AS model, label, score FROM sf)"""


def curve_sql(source: str, by: str = "") -> str:
    """CTEs g, cu (running counts) and pr (with precision and recall) over `source`."""
    keys = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    return f"""g AS (
  SELECT {keys}score, sum(label)::BIGINT AS pos, count(*) AS cnt FROM {source} GROUP BY {keys}score),
cu AS (
  SELECT {keys}score AS threshold, pos, cnt,
         (sum(pos) OVER ({part} ORDER BY score DESC))::BIGINT AS tp,
         (sum(cnt) OVER ({part} ORDER BY score DESC))::BIGINT AS n_at,
         (sum(pos) OVER ({part}))::BIGINT AS positives, (sum(cnt) OVER ({part}))::BIGINT AS n FROM g),
pr AS (
  SELECT *, n_at - tp AS fp, positives - tp AS fn, n - n_at - (positives - tp) AS tn,
         tp::DOUBLE / n_at AS precision, tp::DOUBLE / positives AS recall FROM cu)"""


def fbeta_sql(beta: float, guarded: bool = False) -> str:
    b2 = float(beta) ** 2
    den = f"({b2}::DOUBLE * precision + recall)"
    top = f"{1 + b2}::DOUBLE * (precision * recall)"
    return f"({top} / greatest({den}, 1e-12))" if guarded else f"(CASE WHEN {den} = 0 THEN NULL ELSE {top} / {den} END)"
