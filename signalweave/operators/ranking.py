"""Keep-first, most-recent-N and batching: operators that need an order within a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from signalweave.session import cut_lineage

SALT = "_salt"
RANK = "_rank"
# Up to here the rows that every task keeps of a key are few enough for one task to rank.
SALTED_FROM = 100
SALTS = 64
# Above this many rows per key Spark does not limit keys before the shuffle, so parts must be small.
MAP_SIDE_LIMIT = 1000
MANY_SALTS = 4096


def _first_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(RANK, F.row_number().over(window)).filter(F.col(RANK) <= n)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first by `order`, which must be total for a repeatable result.

    Spark limits each key to its first row before the shuffle as well as after it, so a key
    with very many copies sends one row per task.
    """
    return _first_n(df, keys, order, 1).drop(RANK)


def most_recent(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int,
    spread_by: Sequence[str],
    salts: int | None = None,
) -> DataFrame:
    """The first `n` rows per key by `order`, with their 1-based `rank`.

    For larger `n` a key is first cut down in `salts` parts (chosen by a hash of the `spread_by`
    columns), so that a key holding a large share of all rows is sorted by many tasks; the parts'
    survivors contain the key's first `n`, which the second step picks.
    """
    if salts is None:
        salts = 1 if n < SALTED_FROM else SALTS if n <= MAP_SIDE_LIMIT else MANY_SALTS
    if salts > 1:
        # Key and part in one column: rows that already lie by key would not be moved otherwise.
        part = F.struct(*keys, F.pmod(F.xxhash64(*spread_by), F.lit(salts)).alias("part"))
        df = _first_n(df.withColumn(SALT, part), [SALT], order, n).drop(RANK, SALT)
    return _first_n(df, keys, order, n).withColumnRenamed(RANK, "rank")


def numbered(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add `position`: the 0-based place of a row in the order of the given columns.

    No task sees all rows: rows are range-partitioned and sorted within partitions, and a row's
    place is its index in the partition plus the sizes of the earlier partitions.  The sorted
    rows are checkpointed, because a second evaluation could cut the ranges differently.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = cut_lineage(ranged.withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftright("_place", 33)
    within = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    # One row per partition, so a single-task window is bounded by the number of tasks.
    earlier = W.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    return (
        placed.withColumn("_part", part)
        .join(offsets, "_part")
        .withColumn("position", F.col("_offset") + within)
        .drop("_part", "_place", "_offset")
    )


def id_batches(df: DataFrame, id_col: str, size: int) -> DataFrame:
    """Consecutive ids in lists of `size`: (batch, ids)."""
    batch = F.floor(F.col("position") / F.lit(size)).cast("bigint")
    return (
        numbered(df.select(id_col), [id_col])
        .groupBy(batch.alias("batch"))
        .agg(F.array_sort(F.collect_list(id_col)).alias("ids"))
    )
