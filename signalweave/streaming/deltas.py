"""Counts of a stream as one delta per batch, without state.

A batch writes its own counts into a folder named by its number.  A batch that is run again after a
failure overwrites its folder, so that nothing counts twice, and no earlier result is touched.  Rows that arrive
late add to their month in the delta of the batch they come with.  Reading folds the deltas.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalweave.operators.series import merge_counts, monthly_counts


def delta_writer(target: str, keys: Sequence[str]) -> Callable[[DataFrame, int], None]:
    """What a batch does; safe to repeat for the same batch."""

    def write(batch: DataFrame, number: int) -> None:
        monthly_counts(batch, keys).write.mode("overwrite").parquet(f"{target}/delta/batch={number}")

    return write


def run_deltas(posts: DataFrame, target: str, checkpoint: str, keys: Sequence[str]) -> None:
    """Process all new files; every batch leaves a delta."""
    query = (
        posts.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(delta_writer(target, keys))
        .start()
    )
    query.awaitTermination()


def _folded(spark: SparkSession, target: str) -> tuple[int, DataFrame | None]:
    """The last batch of the newest base, and that base."""
    bases = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{target}/base")
    system = bases.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    done = -1
    if system.exists(bases):
        for entry in system.listStatus(bases):
            name = entry.getPath().getName()
            # A base counts once all of it is written.
            if system.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{target}/base/{name}/_SUCCESS")):
                done = max(done, int(name.removeprefix("upto=")))
    return done, spark.read.parquet(f"{target}/base/upto={done}") if done >= 0 else None


def read_counts(spark: SparkSession, target: str, keys: Sequence[str]) -> DataFrame:
    """The counts of all batches so far."""
    done, base = _folded(spark, target)
    columns = [*keys, "id_count"]
    deltas = spark.read.parquet(f"{target}/delta").filter(F.col("batch") > done).select(columns)
    return merge_counts(deltas if base is None else deltas.unionByName(base.select(columns)), keys)


def compact(spark: SparkSession, target: str, keys: Sequence[str]) -> None:
    """Fold the deltas so far into a base that is read in their place; run it between runs of the stream."""
    last = spark.read.parquet(f"{target}/delta").agg(F.max("batch")).first()[0]
    if last is not None and last > _folded(spark, target)[0]:
        read_counts(spark, target, keys).write.mode("overwrite").parquet(f"{target}/base/upto={last}")
