"""Session helpers shared by jobs, tests and the benchmark."""

from __future__ import annotations

import re
import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "rarelens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC time and Arrow on; `conf` overrides."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Call-site capture costs several JVM round trips per column expression.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir`, or what `setCheckpointDir` was given.

    Only a local session without either gets a temporary folder; on a cluster executors would not share it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    given = spark.sparkContext._jsc.sc().getCheckpointDir()
    if given.isDefined():
        return given.get()
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
    local = tempfile.mkdtemp(prefix="rarelens-")
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the shared folder for one job's intermediate table."""
    return f"{shared_dir(spark)}/rarelens/{purpose}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    Used where several jobs reuse an expensive result: unlike a cache it survives lost executors.
    """
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a table that `materialize` wrote and nothing needs any more."""
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/rarelens/" in path:
            target = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def shuffle_width(spark: SparkSession) -> int:
    """How many reduce tasks a shuffle is planned with."""
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def ship_with_tasks(module: str) -> None:
    """Send a module's functions inside the tasks that use them, so workers need not have the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])
