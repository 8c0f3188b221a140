"""Run registered queries beside their SQL and compare row sets."""

from __future__ import annotations

import math
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(directory: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{directory}/{t}.parquet'")
    return con


def _cell(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(0.0 if v == 0 else v)
    return str(v)


def difference(spark, run, sql, con, directory):
    """None when equal, else a short description; plus the Spark seconds."""
    start = time.time()
    df = run(spark, directory)
    got = [r.asDict() for r in df.collect()]
    took = time.time() - start
    want = con.sql(sql).to_arrow_table()
    if sorted(df.columns) != sorted(want.column_names):
        return f"columns {sorted(df.columns)} != {sorted(want.column_names)}", took
    cols = sorted(df.columns)
    left = sorted(tuple(_cell(r[c]) for c in cols) for r in got)
    right = sorted(tuple(_cell(r[c]) for c in cols) for r in want.to_pylist())
    if left == right:
        kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        names = {"bigint": ("int64",), "int": ("int32",), "double": ("double",), "string": ("string",), "boolean": ("bool",)}
        odd = [(c, kinds[c], str(want.schema.field(c).type)) for c in cols
               if str(want.schema.field(c).type) not in names.get(kinds[c], (str(want.schema.field(c).type),))]
        return (f"TYPES {odd}" if odd else None), took
    only_l = [x for x in left if x not in set(right)][:3]
    only_r = [x for x in right if x not in set(left)][:3]
    return f"rows {len(left)} vs {len(right)}; {cols}; spark only {only_l}; sql only {only_r}", took


if __name__ == "__main__":
    import sys
    sys.path.insert(0, ".")
    import __spark_entry__ as entry
    from rarelens.session import build_session
    directory = sys.argv[1]
    wanted = sys.argv[2:]
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                                 "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(directory)
    queries, oracles = entry.queries(), entry.oracle_sql()
    for name, run in queries.items():
        if wanted and not any(w in name for w in wanted):
            continue
        try:
            if name in oracles:
                problem, took = difference(spark, run, oracles[name], con, directory)
                print(f"{'ok  ' if problem is None else 'DIFF'} {took:6.2f}s {name} {problem or ''}"[:1500], flush=True)
            else:
                start = time.time()
                n = len(run(spark, directory).collect())
                print(f"rows {time.time() - start:6.2f}s {name} {n}", flush=True)
        except Exception as e:  # noqa: BLE001
            print(f"FAIL        {name} {type(e).__name__}: {str(e)[:700]}", flush=True)
