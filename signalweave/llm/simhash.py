"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most r bits have a fingerprint between them that is within r/2
bits of both.  Every fingerprint therefore stands for its ball of variants within r/2 bits, and
fingerprints that meet on a variant are linked: the meeting itself proves the distance.

A ball of radius 2 has 2081 members, too many to shuffle one by one.  What is shuffled is the ball
of the leading bits only: a fingerprint goes to every leading part within r/2 bits of its own, with
the number of flips that it has left, and the task that owns a leading part completes the ball over
the other bits, sorts the variants and links those that collide.  This is the same set of variants,
met in the same way, for a thirtieth of the traffic.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalweave.llm.components import connected
from signalweave.llm.frames import documents, map_texts, stored

BITS = 64
SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
# Variants that a task holds at a time while it completes balls.
VARIANTS_AT_ONCE = 4_000_000
# Fingerprints in a part beyond which it is split by further bits, and by how many.
ROWS_AT_ONCE = 500_000
STEP_BITS = 8


def fingerprint(text: bytes, words: int = SHINGLE_WORDS) -> int:
    """Majority of the bits of the shingles' hashes; repeats count; no word gives 0."""
    parts = text.lower().split()
    if not parts:
        return 0
    line = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    n = max(1, len(parts) - words + 1)
    starts, stops = starts[:n].tolist(), (ends[-n:] - 1).tolist()
    ones = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, 100_000):
        some = zip(starts[at : at + 100_000], stops[at : at + 100_000])
        hashes = np.array([digest(line[a:b], SEED) for a, b in some], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(
    df: DataFrame, words: int = SHINGLE_WORDS, keep: tuple[str, ...] = ("doc_id",), text: str = "text"
) -> DataFrame:
    """The kept columns and `fp`, the fingerprint as a signed 64-bit integer."""

    def values():
        def column(texts: list[bytes]):
            yield pa.array(np.array([fingerprint(t, words) for t in texts], np.uint64).view(np.int64))

        return column

    return map_texts(df, "fp long", values, text, keep)


def ball(bits: range, radius: int) -> np.ndarray:
    """Masks that flip up to `radius` of the bit positions, fewest flips first."""
    masks = [
        sum(1 << b for b in chosen) for k in range(radius + 1) for chosen in combinations(bits, k)
    ]
    return np.array(masks, np.uint64)


def leading_bits(n: int, radius: int) -> int:
    """Leading bits so that a part gets about VARIANTS_AT_ONCE variants at most, all being even."""
    volume = max(1, n) * len(ball(range(BITS), radius))
    return min(24, max(6, int(volume // VARIANTS_AT_ONCE).bit_length()))


def met(fps: np.ndarray, left: np.ndarray, low: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (smallest, other) of fingerprints that meet on a variant of the `low` lowest bits.

    `left` is the number of flips that each has left.  The next bit splits the variants, and with
    them the work, until a part fits in memory.
    """
    size = [len(ball(range(low), r)) for r in range(radius + 1)]
    total = sum(int((left == r).sum()) * size[r] for r in range(radius + 1))
    none = np.empty(0, np.uint64)
    if len(fps) < 2:
        return none, none
    if total > VARIANTS_AT_ONCE and low > 1:
        low -= 1
        mine = (fps >> np.uint64(low)) & np.uint64(1)
        found = []
        for bit in (0, 1):
            flips = left - (mine != bit)
            stay = flips >= 0
            # The bit above is the same for all from here on; only the low bits are compared.
            found.append(met(fps[stay], flips[stay], low, radius))
        return tuple(np.concatenate(x) for x in zip(*found))
    keep = np.uint64((1 << low) - 1)
    variants, owners = [], []
    for r in range(radius + 1):
        own = fps[left == r]
        masks = ball(range(low), r)
        variants.append(((own & keep)[:, None] ^ masks[None, :]).ravel())
        owners.append(np.repeat(own, len(masks)))
    variants, owners = np.concatenate(variants), np.concatenate(owners)
    order = np.argsort(variants, kind="stable")
    variants, owners = variants[order], owners[order]
    head = np.concatenate(([True], variants[1:] != variants[:-1]))
    first = owners[np.flatnonzero(head)[np.cumsum(head) - 1]]
    apart = owners != first
    return first[apart], owners[apart]


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star per connected group of the pairs: (member, smallest member)."""
    nodes, ends = np.unique(np.concatenate((a, b)), return_inverse=True)
    a, b = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        if (root[a] == root[b]).all():
            break
    while (root != root[root]).any():
        root = root[root]
    others = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[others], nodes[root[others]]


def links(distinct: DataFrame, n: int, max_bits: int = MAX_BITS, rows_at_once: int = ROWS_AT_ONCE) -> DataFrame:
    """Links `a`, `b` that connect all of the distinct fingerprints `fp` within max_bits bits.

    Each task returns a star per group it finds, never all pairs of a group.  `n` is the number of
    fingerprints; it only sets how finely the variants are split.  A part that still holds more than
    `rows_at_once` fingerprints, as a dense cluster makes it, is split by further bits.
    """
    if max_bits % 2:
        raise ValueError("max_bits must be even: balls of half the radius meet exactly then")
    radius = max_bits // 2
    low = BITS - leading_bits(n, radius)
    rows = distinct.select("fp", F.lit(radius).alias("left"), F.lit(0).cast("long").alias("part"))
    rows = _descend(rows, BITS, low, radius)
    found = []
    while low > 0:
        sizes = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
        hot = sizes.filter(F.col("n") > rows_at_once).select("part")
        if low <= 2 or hot.isEmpty():
            break
        hot = stored(hot, "simhash-hot")
        found.append(_meetings(rows.join(hot, "part", "left_anti"), low, radius, max_bits))
        deeper = max(0, low - STEP_BITS)
        rows = _descend(rows.join(hot, "part", "left_semi"), low, deeper, radius)
        low = deeper
    found.append(_meetings(rows, low, radius, max_bits))
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def _descend(rows: DataFrame, high: int, low: int, radius: int) -> DataFrame:
    """Send each row to every setting of the bits [low, high) that its flips still reach."""
    masks = ball(range(low, high), radius).view(np.int64).tolist()
    each = rows.select("fp", "left", F.explode(F.lit(masks)).alias("mask")) if high == BITS else (
        rows.select("fp", "left", "part", F.explode(F.lit(masks)).alias("mask"))
    )
    bits = F.shiftright(F.col("fp").bitwiseXOR(F.col("mask")), low)
    if high < BITS:
        width = high - low
        bits = F.shiftleft("part", width).bitwiseOR(bits.bitwiseAND((1 << width) - 1))
    left = F.col("left") - F.bit_count("mask")
    return each.select("fp", left.alias("left"), bits.alias("part")).filter("left >= 0")


def _meetings(rows: DataFrame, low: int, radius: int, max_bits: int) -> DataFrame:
    def complete(rows: pd.DataFrame) -> pd.DataFrame:
        fps = rows["fp"].to_numpy(np.int64).view(np.uint64)
        first, other = met(fps, rows["left"].to_numpy(np.int64), low, radius)
        near = np.bitwise_count(first ^ other) <= max_bits
        member, root = forest(first[near], other[near])
        return pd.DataFrame({"a": member.view(np.int64), "b": root.view(np.int64)})

    return rows.groupBy("part").applyInPandas(complete, "a long, b long")


def near_duplicates(
    df: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, text: str = "text"
) -> DataFrame:
    """`doc_id`, `fp` and `component_id`, the smallest id reachable over links of up to max_bits bits.

    Rows with equal fingerprints are reduced to one before the search.  Repeated ids stay repeated
    rows; a NULL id is never the smallest unless its whole group has no other (then NULL); a NULL
    text has no words and the fingerprint 0, linked like any other.  An empty table gives no row.
    """
    marked = stored(fingerprints(df, words, text=text), "simhash")
    nodes = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    edges = stored(links(nodes.select("fp"), nodes.count(), max_bits), "simhash-links")
    groups = stored(connected(edges), "simhash-groups")
    # The smallest id of a root's members; partial aggregates keep a large group from one task.
    least = groups.join(nodes, groups["node"] == nodes["fp"]).groupBy("root").agg(F.min("least").alias("component_id"))
    named = groups.join(stored(least, "simhash-least"), "root").select(F.col("node").alias("fp"), "component_id")
    chosen = nodes.join(named, "fp", "left").select("fp", F.coalesce("component_id", "least").alias("component_id"))
    # Both sides of the last join are plain scans, so Spark can split a fingerprint that many rows share.
    return marked.join(stored(chosen, "simhash-chosen"), "fp").select("doc_id", "fp", "component_id")


def keep_one(df: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of `df` for each group: a row with the group's smallest id; of rows that repeat that id, one."""
    found = near_duplicates(df, words, max_bits)
    kept = found.select(F.col("component_id").alias("_kept")).distinct()
    rows = df.join(kept, df["doc_id"].eqNullSafe(kept["_kept"]), "left_semi")
    return rows.dropDuplicates(["doc_id"])


def one_of_each_group(df: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """One row of `df` for each group of near-duplicates, whatever the ids: none, repeated or NULL.

    A row is named by its id and 128 bits of its text.  The least name of a group stays, rows without an
    id being last; of rows that are equal in both, one.
    """
    columns = df.columns
    plain = df.toDF(*[f"_c{i}" for i in range(len(columns))])
    doc, text = (F.col(f"_c{columns.index(c)}") for c in ("doc_id", "text"))
    name = F.struct(
        doc.isNull().alias("none"), doc.alias("id"), F.xxhash64(text).alias("h"), F.xxhash64(F.lit(1), text).alias("g")
    )
    found = near_duplicates(plain.select(name.alias("doc_id"), text.alias("text")), words, max_bits)
    kept = found.filter("doc_id <=> component_id").select(F.col("doc_id").alias("_kept")).distinct()
    named = plain.withColumn("_name", name)
    rows = named.join(kept, named["_name"].eqNullSafe(kept["_kept"]), "left_semi").dropDuplicates(["_name"])
    return rows.drop("_name").toDF(*columns)


def simhash_query(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(documents(spark, folder))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
