"""Monthly counts and bounded de-duplication over arriving files.

A run processes what has arrived since the last one and stops; offsets and state live below
the folder the cluster names for checkpoints.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalweave.operators.series import with_keys
from signalweave.session import shared_folder


def read_arriving(
    spark: SparkSession, path: str, schema, pattern: str = "*.parquet", files_per_batch: int = 1000
) -> DataFrame:
    """Parquet files as they arrive in a folder."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(path)
    )


def streaming_counts(posts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Running count per key; the state holds one row per key combination."""
    return with_keys(posts, keys).groupBy(*keys).agg(F.count("id").alias("id_count"))


def run_counts(counts: DataFrame, target: str, checkpoint: str) -> None:
    """Process all new files, then leave the complete counts as a table in `target`."""

    def replace(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(target)

    query = (
        counts.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(replace)
        .start()
    )
    query.awaitTermination()


def distinct_within(
    rows: DataFrame, keys: Sequence[str], time: str, delay: str = "1 day"
) -> DataFrame:
    """Drop copies of a key that arrive within the watermark delay of the first.

    The time column is cast to TIMESTAMP, the only type a watermark accepts.
    """
    timed = rows.withColumn(time, F.col(time).cast("timestamp"))
    return timed.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def run_append(rows: DataFrame, target: str, checkpoint: str) -> None:
    """Process all new files and append the result to the table in `target`."""
    query = (
        rows.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .format("parquet")
        .start(target)
    )
    query.awaitTermination()


def stream_folders(spark: SparkSession, purpose: str) -> tuple[str, str]:
    """Fresh (target, checkpoint) folders below the shared one."""
    root = shared_folder(spark, purpose)
    return f"{root}/table", f"{root}/state"
