"""Sources and runs for streaming queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rarelens.session import scratch_path
from rarelens.sources.tables import event_time, path_status


def stream_table(spark: SparkSession, directory: str, name: str, files_per_batch: int | None = None) -> DataFrame:
    """A table of the sample folder as a file stream (new files are picked up as they arrive)."""
    path = f"{directory}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    status = path_status(spark, path)
    if status is not None and status.isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(directory)


def stream_events(spark: SparkSession, directory: str) -> DataFrame:
    return event_time(stream_table(spark, directory, "events"))


def run_available(stream: DataFrame, purpose: str, output_mode: str = "append") -> DataFrame:
    """Process everything available, exactly once, into a Parquet table in the shared folder, and read it."""
    spark = stream.sparkSession
    path = scratch_path(spark, purpose)
    run = (stream.writeStream.format("parquet").outputMode(output_mode)
           .option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start(f"{path}/table"))
    try:
        run.awaitTermination()
    finally:
        run.stop()
    return spark.read.schema(stream.schema).parquet(f"{path}/table")


def stage(stream: DataFrame, purpose: str) -> DataFrame:
    """A stream of what `run_available` wrote: for a step that Spark does not allow behind another stateful one."""
    table = run_available(stream, purpose)
    folder = table.inputFiles()[0].rsplit("/", 1)[0] if table.inputFiles() else None
    if folder is None:
        return stream
    return stream.sparkSession.readStream.schema(stream.schema).parquet(folder)


def start_continuous(stream: DataFrame, path: str, interval: str = "1 minute", output_mode: str = "append"):
    """The long-running form: same sink layout, a processing-time trigger, restartable from its state."""
    return (stream.writeStream.format("parquet").outputMode(output_mode)
            .option("checkpointLocation", f"{path}/state").trigger(processingTime=interval).start(f"{path}/table"))
