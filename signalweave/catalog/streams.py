"""Streaming queries over the events file; their results must equal the batch ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalweave.catalog.tables import table
from signalweave.functions.temporal import to_month
from signalweave.streaming.monthly import (
    distinct_within,
    read_arriving,
    run_append,
    run_counts,
    stream_folders,
    streaming_counts,
)


def _arriving_events(spark: SparkSession, folder: str) -> DataFrame:
    return read_arriving(spark, folder, table(spark, folder, "events").schema, "events.parquet")


def stream_monthly_counts(spark: SparkSession, folder: str) -> DataFrame:
    posts = _arriving_events(spark, folder).select(
        F.col("event_id").alias("id"),
        to_month(F.col("ts").cast("date")).alias("time_month"),
        F.col("user_id").alias("country"),
        F.col("event_type").alias("category"),
        F.when(F.col("value") < 20, 1).otherwise(0).alias("negative"),
    )
    target, state = stream_folders(spark, "monthly")
    run_counts(streaming_counts(posts, ("time_month", "country", "category", "negative")), target, state)
    return spark.read.parquet(target)


def stream_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    """Each event arrives twice; one copy stays."""
    events = _arriving_events(spark, folder).select("event_id", "event_type", "user_id", "ts")
    twice = events.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    target, state = stream_folders(spark, "dedupe")
    run_append(distinct_within(twice, ["event_id"], "ts", "31 days"), target, state)
    return spark.read.parquet(target).select("event_id", "event_type", "user_id")


QUERIES = {"stream_monthly_counts": stream_monthly_counts, "stream_dedupe": stream_dedupe}

ORACLE = {
    "stream_monthly_counts": """SELECT CAST(date_trunc('month', ts) AS DATE) AS time_month, user_id AS country,
  event_type AS category, CASE WHEN value < 20 THEN 1 ELSE 0 END AS negative, count(event_id) AS id_count
FROM events GROUP BY ALL""",
    "stream_dedupe": "SELECT DISTINCT event_id, event_type, user_id FROM events",
}
