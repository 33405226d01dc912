"""Streams of events through the same transforms (an extension: the batch operators on micro-batches)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def read_events(spark: SparkSession, folder: str, per_trigger: int = 1) -> DataFrame:
    schema = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(folder)


def windowed_counts(events: DataFrame, late: str = "1 hour", window: str = "1 day") -> DataFrame:
    """Counts and sums by window and type; rows later than `late` are dropped, state is bounded by the watermark."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", window), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")


def latest_by_user(events: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Keep the latest event by user in a Parquet table with two alternating versions, so a batch that is replayed gives the same."""
    spark = events.sparkSession

    def merge(batch: DataFrame, number: int) -> None:
        new = batch.groupBy("user_id").agg(F.max(F.struct("ts", "event_id", "event_type")).alias("s"))
        if number:
            new = new.unionByName(spark.read.parquet(f"{table}/v{(number - 1) % 2}")).groupBy("user_id").agg(F.max("s").alias("s"))
        new.write.mode("overwrite").parquet(f"{table}/v{number % 2}")

    return events.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
