"""Structured Streaming over an events table. An extension: the source pipelines have no streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def stream(spark: SparkSession, path: str, files_per_trigger: int = 16) -> DataFrame:
    """The events' Parquet files as a stream."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))


def tumbling(events: DataFrame, size: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts and sums per window and type; rows later than the watermark are dropped by a stream."""
    out = events.withWatermark("ts", late).groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sliding(events: DataFrame, size: str = "2 hours", step: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    out = events.withWatermark("ts", late).groupBy(F.window("ts", size, step).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return out.select(F.col("w.start").alias("start"), "n")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """A user's events with no gap longer than given form a session."""
    out = events.withWatermark("ts", late).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return out.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")
