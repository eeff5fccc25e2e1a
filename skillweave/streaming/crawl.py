"""Crawl events as streams: distinct versions and daily statistics, with watermarks and restartable sinks."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skillweave.session import work_folder


def event_stream(spark: SparkSession, path: str) -> DataFrame:
    """New files of a folder (or of a pattern) of event files."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 16).parquet(path)


def daily_statistics(events: DataFrame, late: str = "2 days") -> DataFrame:
    """Events by day and type; a day is final when the watermark has passed it."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return timed.groupBy(F.window("ts", "1 day"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("day"), "event_type", "n")


def distinct_events(events: DataFrame, late: str = "2 days") -> DataFrame:
    """Each event id once, as long as its repeats come within the watermark."""
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).dropDuplicatesWithinWatermark(["event_id"])


def run_once(stream: DataFrame, mode: str, folder: str) -> str:
    """Runs a stream over all that is there and returns the pattern of its result's folders; the checkpoint beside them lets the
    next call go on from there. Complete results replace the last one; of others each batch has a folder of its number, which
    it writes anew if a lost driver makes it run again, so no row is there twice."""
    query = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/state").foreachBatch(batch_writer(mode, folder)).trigger(availableNow=True).start()
    query.awaitTermination()
    return f"{folder}/out/*"


def batch_writer(mode: str, folder: str) -> Callable[[DataFrame, int], None]:
    """Writes a batch where only this batch writes."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/out/{'all' if mode == 'complete' else f'batch-{number}'}")

    return write


def scratch(spark: SparkSession) -> str:
    """A new folder that all executors share."""
    return f"{work_folder(spark)}/stream-{uuid.uuid4().hex}"
