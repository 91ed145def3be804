"""Recodes, joins with dimensions, struct flattening and set operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalweave.functions.matching import as_column

NULL_SALTS = 256
KEY_COPIES = 32


def negative_label(label: Column | str) -> Column:
    """1 where the classifier label is 0 (the negative class), else 0."""
    return F.when(as_column(label) == 0, 1).otherwise(0)


def negative_score(score: Column | str) -> Column:
    """1 where the score is above 0, else 0."""
    return F.when(as_column(score) > 0, 1).otherwise(0)


def recode(df: DataFrame, column: str, dimension: DataFrame, source: str, target: str) -> DataFrame:
    """Replace values found in the dimension's `source` by its `target`; others stay.

    The dimension is joined plainly: Spark broadcasts it when its size permits and shuffles
    otherwise.  Of several targets for one source the largest is taken, so no row multiplies.
    """
    mapping = (
        dimension.filter(F.col(source).isNotNull())
        .groupBy(F.col(source).alias("_from"))
        .agg(F.max(target).alias("_to"))
    )
    joined = df.join(mapping, df[column] == mapping["_from"], "left")
    return joined.withColumn(column, F.coalesce("_to", column)).drop("_from", "_to")


def _member_keys(dimension: DataFrame, member: str) -> DataFrame:
    """The keys to test against, few copies of each.

    The dimension may itself be a large table in which one key fills a third of the rows.  The
    partial aggregation removes such copies before they are shuffled; the extra grouping by
    input task keeps the join's own shuffle apart, so that Spark can still split a hot key on
    the other side.
    """
    task = F.pmod(F.spark_partition_id(), F.lit(KEY_COPIES))
    return dimension.select(F.col(member).alias("_member"), task.alias("_task")).distinct().drop("_task")


def keep_members(df: DataFrame, column: str, dimension: DataFrame, member: str) -> DataFrame:
    """Rows whose value occurs in the dimension."""
    members = _member_keys(dimension, member)
    return df.join(members, df[column] == members["_member"], "left_semi")


def keep_absent(df: DataFrame, column: str, done: DataFrame, member: str) -> DataFrame:
    """Rows whose value does not occur in `done` (users not yet collected)."""
    members = _member_keys(done, member)
    return df.join(members, df[column] == members["_member"], "left_anti")


def join_users(
    posts: DataFrame,
    users: DataFrame,
    post_key: str,
    user_key: str,
    suffixes: tuple[str, str] = ("_left", "_right"),
) -> DataFrame:
    """Left join of posts with user columns; names present on both sides get the suffixes.

    Posts without an author match nobody, but would all be shuffled to one task; they are
    spread by a second join key that is constant for everyone else.
    """
    shared = set(posts.columns) & set(users.columns)
    left = posts.select(*[F.col(c).alias(c + suffixes[0] if c in shared else c) for c in posts.columns])
    right = users.select(*[F.col(c).alias(c + suffixes[1] if c in shared else c) for c in users.columns])
    lk = post_key + suffixes[0] if post_key in shared else post_key
    rk = user_key + suffixes[1] if user_key in shared else user_key
    hashable = [name for name, kind in left.dtypes if "map<" not in kind]
    spread = F.when(F.col(lk).isNull(), F.pmod(F.xxhash64(*hashable), F.lit(NULL_SALTS))).otherwise(F.lit(0))
    left = left.withColumn("_lsalt", spread.cast("int"))
    right = right.withColumn("_rsalt", F.lit(0))
    on = (F.col(lk) == F.col(rk)) & (F.col("_lsalt") == F.col("_rsalt"))
    return left.join(right, on, "left").drop("_lsalt", "_rsalt")


def flatten(df: DataFrame, column: str) -> DataFrame:
    """Replace a struct column by its fields."""
    return df.select("*", f"{column}.*").drop(column)


def dummy(c: Column | str) -> Column:
    """1 where the number is positive, else 0."""
    return F.coalesce((as_column(c) > 0).cast("int"), F.lit(0))


def row_sum(columns: Sequence[Column | str]) -> Column:
    """Sum across columns of one row, NULL counting 0."""
    return reduce(lambda a, b: a + b, [F.coalesce(as_column(c), F.lit(0)) for c in columns], F.lit(0))


def clip_to_one(c: Column) -> Column:
    return F.least(c, F.lit(1))


def fill_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL to 0 on numeric columns (all of them by default); text stays NULL."""
    numeric = {"int", "bigint", "smallint", "tinyint", "double", "float"}
    chosen = columns or [n for n, t in df.dtypes if t in numeric or t.startswith("decimal")]
    return df.na.fill(0, subset=list(chosen))


def union_all(frames: Sequence[DataFrame], fill_zero: bool = False) -> DataFrame:
    """Bag union by column name; absent columns are NULL, or 0 where numeric."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return fill_counts(out) if fill_zero else out


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows that occur on one side only, from one aggregation over both sides."""
    keys = a.columns
    both = a.withColumn("_side", F.lit(1)).unionByName(b.select(*keys).withColumn("_side", F.lit(2)))
    sides = both.groupBy(*keys).agg(F.bit_or("_side").alias("_sides"))
    return sides.filter(F.col("_sides") != 3).drop("_sides")


def keyed_merge(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row per key from both frames; where both have the key, the right one wins.

    Keys are expected to be unique within a frame, as in a dictionary.
    """
    survivors = left.join(right.select(key), key, "left_anti")
    return survivors.unionByName(right)


def related_ratio(df: DataFrame, dummies: Sequence[str]) -> DataFrame:
    """Share of rows with each dummy set."""
    return df.agg(*[F.avg(d).alias(f"{d}_ratio") for d in dummies])
