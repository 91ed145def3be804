"""Dates, month buckets and yearly ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalweave.functions.matching import as_column


def to_day(c: Column | str) -> Column:
    """DATE from an ISO-8601 string (first ten characters); NULL where it is no date."""
    return F.substring(as_column(c), 1, 10).try_cast("date")


def to_month(c: Column | str) -> Column:
    """First day of the month, as DATE."""
    return F.trunc(as_column(c), "MM")


def within(c: Column | str, start: str, end: str) -> Column:
    """Half-open time range [start, end) on a date or timestamp column."""
    column = as_column(c)
    return (column >= F.lit(start)) & (column < F.lit(end))


def year_ranges(spark: SparkSession, start: int, end: int) -> DataFrame:
    """One row (year, range_start, range_end) per year in [start, end)."""
    years = spark.range(start, end).select(F.col("id").cast("int").alias("year"))
    first = F.make_date(F.col("year"), F.lit(1), F.lit(1))
    return years.select("year", first.alias("range_start"), F.add_months(first, 12).alias("range_end"))
