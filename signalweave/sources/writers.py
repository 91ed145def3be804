"""Sinks.  Parquet unless a CSV is wanted for people; `coalesce` only for small final series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalweave.operators.enrich import keep_absent

SPREAD = 16


def write_csv(df: DataFrame, path: str, encoding: str = "UTF-8", one_file: bool = False) -> None:
    """CSV with header.  `one_file` is for final series of a few thousand rows."""
    out = df.coalesce(1) if one_file else df
    out.write.mode("overwrite").csv(path, header=True, encoding=encoding, escape='"')


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Parquet, optionally in one folder per key (group and year, group and country, user, policy).

    Rows are gathered by key before writing, together with a spread within the key, so that a
    folder gets a few large files and a dominant key is still written by many tasks.
    """
    if not partition_by:
        df.write.mode("overwrite").parquet(path)
        return
    hashable = [name for name, kind in df.dtypes if name not in partition_by and "map<" not in kind]
    spread = [F.pmod(F.xxhash64(*hashable), F.lit(SPREAD))] if hashable else []
    gathered = df.repartition(*partition_by, *spread)
    gathered.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def add_year(df: DataFrame, day: str = "time") -> DataFrame:
    return df.withColumn("year", F.year(day))


def without_result(requested: DataFrame, result: DataFrame, key: str = "id") -> DataFrame:
    """Requested keys that produced no result, each once: the table of failed ids."""
    return keep_absent(requested.select(key).distinct(), key, result, key)
