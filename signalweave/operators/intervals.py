"""Join of points with half-open ranges of any length and overlap, by equality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalweave.operators.once import computed_once

LEVELS = 63


def _number(df: DataFrame, name: str) -> Column:
    """Dates, timestamps and integers as LONG, the first two in microseconds."""
    kind, column = dict(df.dtypes)[name], df[name]
    if kind in ("date", "timestamp_ntz", "timestamp"):
        return F.unix_micros(column.cast("timestamp"))
    return column.cast("long")


def interval_join(points: DataFrame, ranges: DataFrame, at: str, start: str, end: str) -> DataFrame:
    """Every point with every range [start, end) that holds it: all columns of both.

    A range belongs to the level at which buckets are as long as itself or up to twice that, where it meets two
    buckets at most.  A point meets one bucket of each level that some range has.  What shares a bucket is then
    compared.  NULLs and ranges that end before they begin meet nothing.  Column names of both sides must differ.
    """
    size = F.col("_last") - F.col("_first")
    known = computed_once(ranges, _first=_number(ranges, start), _last=_number(ranges, end) - 1).filter("_last >= _first")
    level = F.when(size <= 0, 0).otherwise(F.length(F.bin(size)))
    known = computed_once(known, _level=level)
    # 64 values at most.
    levels = sorted(r[0] for r in known.select("_level").distinct().collect())

    def bucket(place: Column, level: Column) -> Column:
        return F.call_function("shiftright", place, level)

    both = F.array_distinct(F.array(bucket(F.col("_first"), F.col("_level")), bucket(F.col("_last"), F.col("_level"))))
    filed = known.withColumn("_bucket", F.explode(both))
    keys = F.array(*[
        F.struct(F.lit(n).alias("_level"), bucket(F.col("_at"), F.lit(n)).alias("_bucket")) for n in levels
    ]) if levels else F.array().cast("array<struct<_level: int, _bucket: bigint>>")
    asked = computed_once(points, _at=_number(points, at)).filter("_at IS NOT NULL")
    asked = asked.select("*", F.explode(keys).alias("_key")).select(*points.columns, "_at", "_key.*")
    joined = asked.join(filed, ["_level", "_bucket"]).filter("_at BETWEEN _first AND _last")
    return joined.select(*points.columns, *ranges.columns)
