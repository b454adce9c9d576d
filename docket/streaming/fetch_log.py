"""An extension of ours: the fetch log as a stream. Windowed counts with a watermark, and the fold of the newest fetch
of each address into a freshness table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_log(spark: SparkSession, folder: str, schema: str, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def hourly(log: DataFrame, late: str = "1 hour") -> DataFrame:
    """Fetches and values by kind and hour; rows later than the watermark are dropped by the engine."""
    if log.isStreaming:
        log = log.withWatermark("ts", late)
    return log.groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select("w.start", "event_type", "n", "total")


def upsert(batch: DataFrame, known: DataFrame | None) -> DataFrame:
    """The newest fetch of each user: a grouped maximum over the known rows and the new ones."""
    new = batch.groupBy("user_id").agg(F.max("ts").alias("fetched_at"))
    both = new if known is None else known.select("user_id", "fetched_at").unionByName(new)
    return both.groupBy("user_id").agg(F.max("fetched_at").alias("fetched_at"))
