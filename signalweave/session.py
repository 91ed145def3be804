"""Session set-up and the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job wants.  Broadcasts are left to Spark's own size check
# (spark.sql.autoBroadcastJoinThreshold, re-checked at run time by AQE); nothing in
# this package forces one with a hint.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Rows that a task sorts or gathers in memory at a time: a few hundred bytes each.
ROWS_A_TASK = 400_000


def build_session(
    app: str = "signalweave", master: str | None = None, **conf: str
) -> SparkSession:
    """A session with the defaults above; keyword `conf` uses `__` for the dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = DEFAULTS | {k.replace("__", "."): str(v) for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the one the cluster names in spark.checkpoint.dir.

    A machine-local folder is used only where that setting is absent and the session is a local one (tests,
    laptops).  On a cluster each executor would write to a disk of its own, so that the setting is required.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder (master {master})")
        return tempfile.mkdtemp(prefix=f"{purpose}-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise `df` by a reliable checkpoint, so that lost executors cost no recompute."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark, "checkpoint"))
    return df.checkpoint(eager=True)


def tasks_for_rows(df: DataFrame, rows: int | None = None) -> int:
    """As many partitions as give each about `rows` rows at most, and one per core at least.

    For steps that sort or gather narrow rows: the number of shuffle partitions is a setting and does not follow the input, and
    adaptive execution joins them by compressed bytes, of which keys in rows have few.
    """
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // (rows or ROWS_A_TASK)))


def spread_rows(df: DataFrame, key: str) -> DataFrame:
    """Deal the rows of a small input out to all cores before costly work on each row.

    A file is read by as many tasks as it has row groups, so a small table of long texts may
    occupy a single core.  An input with at least a split per core is left as it is: at scale
    this adds no shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, key)
