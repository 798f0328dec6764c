"""Streaming forms, as an extension: new files as a stream of admitted inputs, and windowed counts of events."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from quire.sources.files import admitted


def incoming(spark: SparkSession, folder: str, most_mb: float = 200, files_a_batch: int = 1000) -> DataFrame:
    """A stream of admitted files (path, length, content, kind, rejection) that appear in folder."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    return admitted(spark.readStream.format("binaryFile").schema(schema).option("maxFilesPerTrigger", files_a_batch).load(folder), most_mb)


def parsed_stream(files: DataFrame, parse: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Parses each batch and writes it to out under its batch number, so that a repeated batch replaces itself."""

    def write(batch: DataFrame, number: int) -> None:
        parse(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return files.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def event_counts(events: DataFrame, late: str = "10 minutes", size: str = "5 minutes") -> DataFrame:
    """Counts of events (ts, event_type) in windows of event time; rows later than the watermark are left out."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", size), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
