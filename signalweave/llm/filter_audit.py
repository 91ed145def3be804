"""Filter interaction audit: what every order of the quality filters removes, and each filter's share.

A document is reduced to the set of filters it fails.  The states of a filtering run are the sets of
filters applied so far, and an edge adds one filter to a state; what the edge removes depends on the
state only and not on the order that led there.  Paths are counted forward from the empty set and
backward from the full one: an edge lies on (orders that reach its start) times (orders that leave its
end) of all orders, which is its weight in a filter's Shapley sum.  The steps of every order are read
from the same edges.
"""

from __future__ import annotations

import hashlib
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from signalweave.llm.frames import documents, map_texts, stored

FILTERS = "ABCDE"
SYMBOLS = b"#$%&*|"


def text_failures(text: bytes) -> int:
    """Bits 0 to 3: the text fails A (few words), B (few distinct words), C (many capitals), D (a symbol)."""
    words = text.split()
    units = np.frombuffer(text, np.uint8)
    # Code points: bytes other than UTF-8 continuation bytes.
    chars = int(((units & 0xC0) != 0x80).sum())
    capitals = int(((units >= 65) & (units <= 90)).sum())
    return (
        (len(words) < 200)
        + 2 * (100 * len(set(words)) < 50 * len(words))
        + 4 * (100 * capitals > 2 * chars)
        + 8 * (len(text.translate(None, SYMBOLS)) < len(text))
    )


def failures(df: DataFrame, labels: DataFrame) -> DataFrame:
    """`part`, `failed` (one bit per filter), `good`, `toxic` of every row of `df`.

    A NULL text counts as empty and a NULL source as the part "".  E: a row of a smaller id has the
    same text; rows of one id are no copies of each other, and a NULL id counts as the largest.  Of
    several labels of one id, one that says 1 is enough; a row without an id has none.  Texts are
    compared by their SHA-256, so that only this and the bits are shuffled.
    """

    def values():
        def both(texts):
            yield pa.array([text_failures(t) for t in texts], pa.int32())
            yield pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())

        return both

    rows = df.select(
        df["doc_id"].cast("long").alias("doc_id"), F.coalesce(df["source"].cast("string"), F.lit("")).alias("part"),
        df["text"].alias("text"),
    )
    rows = stored(map_texts(rows, "failed int, digest binary", values, keep=("doc_id", "part")), "audit-rows")
    # Partial minima first: a text with very many copies sends one row per task, and the rows that meet
    # the minimum again are two plain shuffled tables, whose large partitions Spark can split.
    shared = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    shared = shared.filter("copies > 1 AND first IS NOT NULL").select("digest", "first")
    known = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    copied = F.col("first").isNotNull() & (F.col("doc_id").isNull() | (F.col("doc_id") > F.col("first")))
    return (
        rows.join(shared, "digest", "left")
        .select("doc_id", "part", (F.col("failed") + F.when(copied, 16).otherwise(0)).alias("failed"))
        .join(known, "doc_id", "left")
        .select("part", "failed", *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")])
    )


def path_counts(n: int) -> tuple[list[int], list[int]]:
    """Per subset of `n` filters: the orders that reach it from the empty set, and that leave it for the full one."""
    states = range(1 << n)
    forward, backward = [1] + [0] * (len(states) - 1), [0] * (len(states) - 1) + [1]
    for state in states:
        for f in range(n):
            if not state >> f & 1:
                forward[state | 1 << f] += forward[state]
    for state in reversed(states):
        for f in range(n):
            if not state >> f & 1:
                backward[state] += backward[state | 1 << f]
    return forward, backward


def lattice(n: int) -> list[tuple[int, int, int]]:
    """The edges: state before, filter, and the number of orders that pass over the edge."""
    forward, backward = path_counts(n)
    return [
        (state, f, forward[state] * backward[state | 1 << f])
        for state in range(1 << n)
        for f in range(n)
        if not state >> f & 1
    ]


def steps(names: str) -> list[tuple[str, int, int, int]]:
    """Every order with its steps: order, step from 1, state before the step, filter of the step."""
    found = []
    for order in permutations(range(len(names))):
        before = 0
        for step, f in enumerate(order, 1):
            found.append(("".join(names[i] for i in order), step, before, f))
            before |= 1 << f
    return found


def edge_counts(entries: DataFrame, names: str = FILTERS) -> DataFrame:
    """Per part and edge of the lattice, what happens there; `entries` as from `failures`.

    Rows are first counted by part and failed set, at most 2 to the number of filters for a part.
    """
    patterns = entries.groupBy("part", "failed").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic")
    )
    edges = F.array(*[
        F.struct(F.lit(s).alias("before"), F.lit(f).alias("filter"), F.lit(w).cast("long").alias("weight"))
        for s, f, w in lattice(len(names))
    ])
    each = patterns.withColumn("e", F.explode(edges)).select("part", "failed", "n", "good", "toxic", "e.*")
    own = F.call_function("shiftleft", F.lit(1), F.col("filter"))
    fails = F.col("failed").bitwiseAND(own) != 0
    reached = F.col("failed").bitwiseAND(F.col("before")) == 0

    def total(condition: Column, what: str = "n") -> Column:
        return F.sum(F.when(condition, F.col(what)).otherwise(0))

    counted = each.groupBy("part", "before", "filter", "weight").agg(
        total(reached & ~fails).alias("kept"),
        total(reached & fails).alias("removed"),
        total(~reached & fails).alias("redundant"),
        total(F.col("failed") == own).alias("unique_fails"),
        total(reached & fails, "good").alias("good_lost"),
        total(reached & fails, "toxic").alias("toxic_lost"),
    )
    # A filter has 2 to the number of the other filters edges in a part: a fixed number of rows.
    share = F.sum(F.col("weight") * F.col("removed")).over(Window.partitionBy("part", "filter"))
    return counted.withColumn("shapley", share)


def audit(entries: DataFrame, names: str = FILTERS) -> DataFrame:
    """One row per part, order of the filters and step; an empty table has no part and gives no row.

    `shapley` is the filter's removals summed over all orders; divided by their number it is the
    filter's Shapley value, and these add up to what all filters together remove.
    """
    spark = entries.sparkSession
    # 600 rows for five filters, whatever the data.
    every = spark.createDataFrame(steps(names), "filter_order string, step int, before int, filter int")
    return edge_counts(entries, names).join(F.broadcast(every), ["before", "filter"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


def filter_audit_query(spark: SparkSession, folder: str) -> DataFrame:
    return audit(failures(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet")))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first
  FROM documents),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT part, good, toxic,
         (len(w) < 200)::INTEGER + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INTEGER
         + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t))::INTEGER
         + 8 * regexp_matches(t, '[#$%&*|]')::INTEGER
         + 16 * (first IS NOT NULL AND (d.doc_id IS NULL OR d.doc_id > first))::INTEGER AS failed
  FROM d LEFT JOIN l USING (doc_id)),
p AS (
  SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM m GROUP BY part, failed),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (
  SELECT concat(a.x, b.x, c.x, d.x, e.x) AS filter_order FROM f AS a, f AS b, f AS c, f AS d, f AS e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (
  SELECT filter_order, step::INTEGER AS step, substr(filter_order, step, 1) AS x,
         coalesce(list_sum([1 << (ascii(y) - 65) for y in string_split(substr(filter_order, 1, step - 1), '') if y <> '']), 0)::INTEGER AS before
  FROM o, range(1, 6) AS r(step)),
k AS (
  SELECT part, filter_order, step, x,
         sum(n) FILTER (failed & before = 0 AND failed & own = 0) AS kept,
         sum(n) FILTER (failed & before = 0 AND failed & own <> 0) AS removed,
         sum(n) FILTER (failed & before <> 0 AND failed & own <> 0) AS redundant,
         sum(n) FILTER (failed = own) AS unique_fails,
         sum(good) FILTER (failed & before = 0 AND failed & own <> 0) AS good_lost,
         sum(toxic) FILTER (failed & before = 0 AND failed & own <> 0) AS toxic_lost
  FROM (SELECT *, 1 << (ascii(x) - 65) AS own FROM s) AS s, p GROUP BY ALL)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, x), 0)::BIGINT AS shapley
FROM k
"""
