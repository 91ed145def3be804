"""Counts of a growing folder: files that were counted before are not read again.

A run writes the partial counts of new and changed files, and then a row for each of them into the
manifest, which names the run.  Only partial counts that the manifest names are ever read, so that a run which
fails half way leaves nothing behind that counts, and a file that changed counts by its latest run.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from signalweave.operators.series import merge_counts, monthly_counts

MANIFEST = "file STRING, size BIGINT, changed TIMESTAMP, run BIGINT"


def present_files(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """`file`, `size` and `changed` of the files below a folder; their contents are not read."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    return listed.select(F.col("path").alias("file"), F.col("length").alias("size"), F.col("modificationTime").alias("changed"))


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def read_manifest(spark: SparkSession, store: str) -> DataFrame:
    """The latest entry of each file."""
    folder = f"{store}/manifest"
    rows = spark.read.schema(MANIFEST).parquet(folder) if _exists(spark, folder) else spark.createDataFrame([], MANIFEST)
    latest = W.partitionBy("file").orderBy(F.desc("run"))
    return rows.withColumn("_n", F.row_number().over(latest)).filter("_n = 1").drop("_n")


def pending_files(spark: SparkSession, path: str, store: str, pattern: str = "*.parquet") -> DataFrame:
    """Files that the manifest does not have, or has with another size or time."""
    known = read_manifest(spark, store).drop("run")
    return present_files(spark, path, pattern).join(known, ["file", "size", "changed"], "left_anti")


def count_new_files(
    spark: SparkSession,
    path: str,
    store: str,
    keys: Sequence[str],
    to_posts: Callable[[DataFrame], DataFrame],
    pattern: str = "*.parquet",
    schema: str | None = None,
) -> list[str]:
    """Count the pending files into `store` and return their names, which are what the driver needs for the scan.

    `to_posts` makes rows with `id` and the keys of a file's rows; a column `file` must be left as it is.
    """
    pending = pending_files(spark, path, store, pattern).collect()
    if not pending:
        return []
    files = [r["file"] for r in pending]
    reader = spark.read.schema(schema) if schema else spark.read
    rows = reader.parquet(*files).select("*", F.col("_metadata.file_path").alias("file"))
    run = time.time_ns()
    monthly_counts(to_posts(rows), ("file", *keys)).write.parquet(f"{store}/partials/run={run}")
    entries = spark.createDataFrame([(r["file"], r["size"], r["changed"], run) for r in pending], MANIFEST)
    entries.write.mode("append").parquet(f"{store}/manifest")
    return files


def _name(column: str):
    """The path of a file without its scheme, in which listings and scans may differ."""
    return F.regexp_replace(F.url_decode(F.replace(column, F.lit("+"), F.lit("%2B"))), "^[a-z0-9]+:/+", "/")


def folded_counts(spark: SparkSession, store: str, keys: Sequence[str]) -> DataFrame:
    """Counts over all files, each by its latest run."""
    if not _exists(spark, f"{store}/partials"):
        raise ValueError(f"nothing has been counted into {store}")
    latest = read_manifest(spark, store).select(_name("file").alias("_file"), "run")
    partials = spark.read.parquet(f"{store}/partials").withColumn("_file", _name("file"))
    return merge_counts(partials.join(latest, ["_file", "run"], "left_semi"), keys)
