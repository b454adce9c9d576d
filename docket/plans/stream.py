"""The batch form of the stream operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docket.catalog import table
from docket.registry import query
from docket.streaming import fetch_log


@query("ext_hourly_fetches", "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H') AS hour, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def ext_hourly_fetches(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = fetch_log.hourly(table(spark, sf_dir, "events"))
    return h.select(F.date_format("start", "yyyy-MM-dd HH").alias("hour"), "event_type", "n", F.round("total", 4).alias("total"))
