"""Keep Catalyst from evaluating a costly expression several times.

Catalyst substitutes a column's expression into every filter above it, and adds a non-empty
test of its own below an inner explode.  For a text search that doubles or triples the work.
A generated column is not substituted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add the columns, each evaluated exactly once per row whatever is done with them later."""
    packed = F.struct(*[c.alias(name) for name, c in columns.items()])
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    unpacked = [F.col(f"_once.{name}").alias(name) for name in columns]
    one_row = df.select(*kept, F.explode(F.array(packed)).alias("_once"))
    return one_row.select(*kept, *unpacked)


def explode_once(df: DataFrame, name: str, items: Column) -> DataFrame:
    """One row per item of an array without NULL items; rows with an empty array go away.

    The outer explode and the filter on its output say the same as an inner explode, but leave
    the array to be computed once.
    """
    return df.withColumn(name, F.explode_outer(items)).filter(F.col(name).isNotNull())
