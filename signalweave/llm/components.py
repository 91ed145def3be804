"""Connected components over links in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalweave.llm.frames import stored


def connected(edges: DataFrame) -> DataFrame:
    """`node`, `root` for every end of the links `a`, `b`; the root is the smallest node of the component.

    Alternates large-star and small-star steps, which take a logarithmic number of rounds in practice
    and never gather a component: a step needs the minimum of a node's neighbours only.  The minimum
    is a partial aggregate, written and joined back, so that Spark can split the rows of a hub.  Only
    one checksum row per round reaches the driver.
    """
    ends = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    links = edges.filter("a != b").select(*ends).distinct()
    links = stored(links, "components")
    before = None
    while True:
        # Large star: neighbours above a node move to the smallest of its neighbourhood.
        both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")), "components")
        large = both.join(least, "u").filter("v > u")
        large = large.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        large = stored(large, "components")
        # Small star: a node and its smaller neighbours move to the smallest of these.
        low = stored(large.groupBy("u").agg(F.min("v").alias("m")), "components")
        moved = F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v"))
        small = large.join(low, "u").select(moved.alias("u"), F.col("m").alias("v"))
        links = stored(small.filter("u != v").distinct(), "components")
        checksum = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        after = links.agg(F.count(F.lit(1)), checksum).first()
        if after == before:
            break
        before = after
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
