"""Streaming forms of deduplication and counting over `events`. An extension: batch plans do not need it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def event_stream(spark: SparkSession, folder: str, schema) -> DataFrame:
    """Files of a folder as a stream; ts becomes a timestamp, as watermarks need one."""
    return spark.readStream.schema(schema).parquet(folder).withColumn("ts", F.col("ts").cast("timestamp"))


def first_seen(events: DataFrame, key: str, delay: str = "1 hour") -> DataFrame:
    """The first event of a key; keys are forgotten once the watermark has passed them."""
    return events.withWatermark("ts", delay).dropDuplicatesWithinWatermark([key])


def windowed_counts(events: DataFrame, by: str, width: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """Counts and sums per window and key; late events within the delay still count."""
    grouped = events.withWatermark("ts", delay).groupBy(F.window("ts", width), by)
    return grouped.agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), by, "n", "total")


def run_available(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Write all that is there, exactly once, and stop; a later call goes on from the checkpoint."""
    df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path).awaitTermination()
