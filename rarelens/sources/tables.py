"""Table readers and writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rarelens.contracts import RAW_SCHEMA, ContractError, find_target, numeric_columns


def path_status(spark: SparkSession, path: str):
    """Hadoop file status, or None when absent; works for every file system Spark can read."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getFileStatus(hadoop) if fs.exists(hadoop) else None


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = RAW_SCHEMA) -> DataFrame:
    """CSV with a header. Giving the schema avoids a second scan; `None` infers it."""
    if path_status(spark, path) is None:
        raise FileNotFoundError(path)
    reader = spark.read.option("header", True)
    return reader.schema(schema).csv(path) if schema is not None else reader.option("inferSchema", True).csv(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """CSV or Parquet by file name."""
    return read_csv(spark, path, None) if path.endswith(".csv") else spark.read.parquet(path)


def preview(df: DataFrame, rows: int = 10) -> DataFrame:
    return df.limit(rows)


def read_target(df: DataFrame) -> DataFrame:
    """Only the target column: the scan reads nothing else."""
    return df.select(find_target(df))


def nan_to_null(df: DataFrame) -> DataFrame:
    """The ingest rule: NaN means missing. Infinities stay, so they can be reported."""
    floating = (T.DoubleType, T.FloatType)
    return df.select(*[
        F.nanvl(F.col(f.name), F.lit(None)).alias(f.name) if isinstance(f.dataType, floating) else F.col(f.name)
        for f in df.schema.fields])


def read_split(spark: SparkSession, path: str, split: str, target: str = "Class") -> DataFrame:
    """One split of a table partitioned by `split`: other splits' files are never opened."""
    df = spark.read.parquet(path)
    if target not in df.columns:
        raise ContractError(f"target column {target!r} not in {path}")
    return df.where(F.col("split") == split).drop("split")


def features_and_label(df: DataFrame, target: str = "Class") -> tuple[list[str], DataFrame]:
    """Feature names (numeric, target excluded) and the table with the target last."""
    if target not in df.columns:
        raise ContractError(f"target column {target!r} not found")
    names = [c for c in numeric_columns(df) if c != target]
    return names, df.select(*names, target)


def write_splits(df: DataFrame, path: str) -> None:
    """Numeric columns + target partitioned by split."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    (df.select(*columns) if columns else df).write.mode("overwrite").option("header", True).csv(path)


def file_fingerprints(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes, sha256) per file, hashed where the file is read."""
    return spark.read.format("binaryFile").load(path).select(
        "path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def row_fingerprint(*columns: Column | str) -> Column:
    """60 bits of a row digest as a long. Values carry their length and NULL a mark, so neighbours don't run together."""
    parts = [(F.col(c) if isinstance(c, str) else c).cast("string") for c in columns]
    digest = F.md5(F.concat(*[F.coalesce(F.concat(F.length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts]))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def table_fingerprint(df: DataFrame, columns: Sequence[Column | str] | None = None) -> DataFrame:
    """Order-insensitive fingerprint of a table of any size: one partial aggregation.

    The xor alone would cancel pairs of equal rows, so the exact sum and the count go with it.
    """
    h = row_fingerprint(*(columns or df.columns))
    return df.agg(F.count(F.lit(1)).alias("row_count"), F.bit_xor(h).alias("xor_hash"),
                  F.sum(h.cast("decimal(38,0)")).cast("string").alias("sum_hash"))


# Views of the sample tables used by the registered queries -------------------------------------------------

def sample_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def event_time(df: DataFrame, column: str = "ts") -> DataFrame:
    return df.withColumn(column, F.col(column).cast("timestamp"))


def transactions_from_events(events: DataFrame) -> DataFrame:
    """row_id, ts, user_id, Time (seconds since the first row), Amount, Class.

    The first timestamp is a scalar subquery: one tiny aggregate, no join.
    """
    e = event_time(events)
    start = e.agg(F.min("ts").alias("start")).scalar()
    micros = F.unix_micros("ts") - F.unix_micros(start)
    return e.select(F.col("event_id").alias("row_id"), "ts", "user_id", (micros / F.lit(1e6)).alias("Time"),
                    F.col("value").alias("Amount"), (F.col("event_type") == "error").cast("int").alias("Class"))


def transactions(spark: SparkSession, directory: str) -> DataFrame:
    return transactions_from_events(sample_table(spark, directory, "events"))


def _sample_score(model: str) -> Column:
    if model == "coarse":
        code, base = F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 104729, 1009
    elif model == "fine":
        code, base = F.col("l_orderkey") * 69069069 + F.col("l_linenumber").cast("bigint") * 1299709, 2147483647
    else:
        raise ValueError(model)
    noise = (code % base) / F.lit(float(base)) * F.lit(0.7)
    return noise + F.when(F.col("l_returnflag") == "R", F.lit(0.2)).otherwise(F.lit(0.0))


def scored_lineitems(spark: SparkSession, directory: str, model: str = "coarse") -> DataFrame:
    """A scored set: `coarse` has about 2,000 distinct scores (many ties), `fine` nearly one per row."""
    label = (F.col("l_returnflag") == "R").cast("int").alias("label")
    return sample_table(spark, directory, "lineitem").select(
        "l_orderkey", "l_linenumber", label, _sample_score(model).alias("score"))


def two_models(spark: SparkSession, directory: str) -> DataFrame:
    """Both scorers stacked as (model, label, score), from one scan."""
    scores = F.array(*[F.struct(F.lit(m).alias("model"), _sample_score(m).alias("score")) for m in ("coarse", "fine")])
    label = (F.col("l_returnflag") == "R").cast("int").alias("label")
    return sample_table(spark, directory, "lineitem").select(label, F.explode(scores).alias("_s")).select(
        "_s.model", "label", "_s.score")


def embedding_features(spark: SparkSession, directory: str, width: int = 64) -> DataFrame:
    """vec_id, Class, e0..e<width-1> as doubles."""
    emb = sample_table(spark, directory, "embeddings")
    return emb.select("vec_id", (F.col("label") == 0).cast("int").alias("Class"),
                      *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(width)])
