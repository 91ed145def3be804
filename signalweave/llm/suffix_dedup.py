"""Removal of long repeated passages: byte positions in runs that share a seed.

A position is the start of a string of `length` bytes; it is repeated if that string starts anywhere
else.  Prefix doubling, which ranks all positions at offsets that grow up to `length`, would move many
times the input, so positions travel as runs.  Each string is owned by the seed in it, a string of SEED bytes, whose hash
is lowest; equal strings have their seeds in the same place.  The positions that own the same seed
follow each other: they are a run, and their distances to the seed are their slots.

The rank of a run is the hash of its seed.  Spark groups runs by rank; a run of unique rank has no
repeated position and goes.  Two runs that are equal in all their bytes are repeated throughout and
are settled.  The others are cut into cells of neighbouring slots, whose strings share more bytes
than the run's did: from rank to rank the common part grows towards `length`.  The cells are ranked
again, and so on, until a cell is unique, settled, or a single position, whose rank is that of all
its bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalweave.llm.frames import documents, release, slices, stored, utf8

LENGTH = 200
SEED = 40
# A run or cell is cut into so many cells for the next round.
CUT = 4
# Positions of a text that are worked on at a time; 24 bits hold a place among them.
BLOCK = 1 << 20
PLACE_BITS = 24
# Bits of the filter of repeated seeds: fixed bounds, whatever the input.
FILTER_BITS = (22, 28)

_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def seed_hashes(data: bytes, seed: int = SEED) -> np.ndarray:
    """A 64-bit hash of the `seed` bytes from each position on; `seed` is a multiple of 8."""
    units = np.frombuffer(data, np.uint8)
    n = len(units) - seed + 1
    words = np.ndarray((len(units) - 7,), "<u8", units, 0, (1,))
    total = np.zeros(n, np.uint64)
    for j in range(seed // 8):
        total += words[8 * j : 8 * j + n] * _FACTORS[j % len(_FACTORS)]
        total ^= total >> np.uint64(31)
    total *= np.uint64(0xFF51AFD7ED558CCD)
    total ^= total >> np.uint64(33)
    return total


def runs(data: bytes, length: int = LENGTH, seed: int = SEED) -> Iterator[tuple[np.ndarray, ...]]:
    """Blocks of runs of a text: first position, number of positions, place and hash of the seed."""
    width = length - seed + 1
    low = np.uint64((1 << PLACE_BITS) - 1)
    positions = len(data) - length + 1
    for at in range(0, max(0, positions), BLOCK):
        n = min(BLOCK, positions - at)
        hashes = seed_hashes(data[at : at + n + length - 1], seed)
        least = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
        # Minimum over `width` neighbours by doubling; the place in the low bits breaks ties leftwards.
        reach = 1
        while 2 * reach <= width:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if reach < width:
            least = np.minimum(least[: n], least[width - reach : width - reach + n])
        places = (least[:n] & low).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], places[1:] != places[:-1])))
        counts = np.diff(np.concatenate((first, [n])))
        own = places[first]
        yield first + at, counts, own + at, hashes[own].view(np.int64)


def text_key(data: bytes) -> bytes:
    """What tells texts apart that have one id or none: 128 bits of a SHA-256."""
    return hashlib.sha256(data).digest()[:16]


def _halves(data: bytes) -> tuple[int, int]:
    whole = xxhash.xxh3_128_intdigest(data)
    a, b = whole >> 64, whole & 0xFFFFFFFFFFFFFFFF
    return a - (1 << 64) * (a >> 63), b - (1 << 64) * (b >> 63)


def _seeds(df: DataFrame, length: int, seed: int) -> DataFrame:
    """The rank of every run of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                for own in utf8(part, "_text"):
                    for _, _, _, ranks in runs(own, length, seed):
                        yield pa.RecordBatch.from_arrays([pa.array(ranks)], names=["rank"])

    return df.select("_text").mapInArrow(run, "rank long")


def bloom(values: DataFrame, name: str) -> np.ndarray:
    """A Bloom filter of a column of 64-bit hashes, two bits each, in at most 2^FILTER_BITS[1] bits."""
    ranks = values.select(F.col(name).alias("rank"))
    n = ranks.count()
    bits = min(FILTER_BITS[1], max(FILTER_BITS[0], (16 * n).bit_length()))
    low = (1 << bits) - 1
    places = F.array(F.col("rank").bitwiseAND(low), F.shiftrightunsigned("rank", 64 - bits))
    parts = ranks.select(F.explode(places).alias("place")).select(
        F.shiftright("place", 6).alias("word"), F.expr("shiftleft(1L, cast(place & 63 as int))").alias("bit")
    )
    grouped = parts.groupBy("word").agg(F.bit_or("bit").alias("bits"))
    table = np.zeros(1 << (bits - 6), np.int64)
    for batch in grouped.toLocalIterator(prefetchPartitions=True):
        table[batch["word"]] = batch["bits"]
    return table.view(np.uint64)


def _held(table: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    bits = (len(table) * 64).bit_length() - 1
    keys = ranks.view(np.uint64)
    held = np.ones(len(keys), bool)
    for place in (keys & np.uint64((1 << bits) - 1), keys >> np.uint64(64 - bits)):
        held &= (table[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) != 0
    return held


def _chosen_runs(
    df: DataFrame, ranks: np.ndarray, length: int, seed: int, names: np.ndarray | None = None
) -> DataFrame:
    """The runs whose rank passes a filter; given a filter of names `a`, the bytes of those that pass it too.

    `slot` is the distance of the first position to the seed.  `a` and `b` stand for slot, number of
    positions and bytes together.
    """
    sent = df.sparkSession.sparkContext.broadcast((ranks, names))
    kind = df.schema["doc_id"].dataType.simpleString()
    columns = ["doc_id", "key", "start", "n", "slot", "rank", "a", "b", "bytes"]

    def found(texts: list[bytes]) -> Iterator[tuple]:
        ranks, names = sent.value
        seen = set()
        for i, own in enumerate(texts):
            key = text_key(own)
            for first, counts, place, rank in runs(own, length, seed):
                chosen = np.flatnonzero(_held(ranks, rank))
                for start, n, at, r in zip(*(x[chosen].tolist() for x in (first, counts, place, rank))):
                    data = own[start : start + n - 1 + length]
                    a, b = _halves(data + (at - start).to_bytes(2, "little"))
                    if names is None:
                        yield i, key, start, n, at - start, r, a, b, None
                    elif (a, b) not in seen:
                        seen.add((a, b))
                        yield i, key, start, n, at - start, r, a, b, data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                rows = list(found(utf8(part, "_text")))
                if names is not None and rows:
                    passed = _held(sent.value[1], np.array([r[6] for r in rows], np.int64))
                    rows = [r for r, good in zip(rows, passed) if good]
                at, *rest = zip(*rows) if rows else [[] for _ in columns]
                ids = part.column("doc_id").take(pa.array(at, pa.int64()))
                key, *numbers, data = rest
                arrays = [pa.array(key, pa.binary()), *[pa.array(c, pa.int64()) for c in numbers], pa.array(data, pa.binary())]
                yield pa.RecordBatch.from_arrays([ids, *arrays], names=columns)

    schema = f"doc_id {kind}, key binary, start long, n long, slot long, rank long, a long, b long, bytes binary"
    return df.select("doc_id", "_text").mapInArrow(run, schema)


def _cells(runs_: DataFrame, size: int, length: int) -> DataFrame:
    """Cut runs or cells into the cells of `size` slots that they meet, each with the rank of its common part.

    The slots of a cell lie between fixed multiples of `size`, so that equal positions of different
    texts meet in cells of the same slots.
    """
    names = ["of_a", "of_b", "open", "at", "n", "slot", "rank", "a", "b", "bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                # Slots fall from `slot` by one with each position.
                slot, n, data, done = r["slot"], r["n"], r["bytes"], 0
                while done < n:
                    top = slot - done
                    floor = top // size * size
                    count = min(n - done, top - floor + 1)
                    own = data[done : done + count - 1 + length]
                    # Shared by all strings with slots floor .. floor + size - 1, seen from the seed.
                    begin, end = top - floor, top - (floor + size - 1) + length
                    rank, _ = _halves(own[begin:end] + floor.to_bytes(2, "little"))
                    a, b = _halves(own + top.to_bytes(2, "little"))
                    rows.append((r["of_a"], r["of_b"], r["open"], r["at"] + done, count, top, rank, a, b, own))
                    done += count
            columns = list(zip(*rows)) if rows else [[] for _ in names]
            kinds = [pa.int64(), pa.int64(), pa.bool_(), *[pa.int64()] * 6, pa.binary()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = (
        "of_a long, of_b long, open boolean, at long, n long, slot long, rank long, a long, b long, bytes binary"
    )
    return runs_.select("of_a", "of_b", "open", "at", "n", "slot", "bytes").mapInArrow(run, schema)


def _ranked(cells: DataFrame, purpose: str) -> tuple[DataFrame, DataFrame]:
    """Rerank: the cells with `copies`, how many are equal in all bytes; and those that stay to be compared.

    Of equal cells one goes on, as settled, and only where an open one of the same rank may need it.
    """
    equal = cells.groupBy("rank", "a", "b").agg(F.count(F.lit(1)).alias("copies"))
    equal = stored(equal, purpose)
    ranks = equal.groupBy("rank").agg(
        F.count(F.lit(1)).alias("kinds"), F.max((F.col("copies") == 1).cast("int")).alias("any_open")
    )
    going = equal.join(stored(ranks.filter("kinds > 1 AND any_open = 1"), purpose), "rank", "left_semi")
    return equal, going


def _settled_parts(open_runs: DataFrame, length: int, seed: int) -> DataFrame:
    """`a`, `b`, `at`, `n`: the repeated positions of runs of which there is one, by rounds of cutting."""
    spark = open_runs.sparkSession
    size = length - seed + 1
    found = open_runs.filter("false").select(F.col("of_a").alias("a"), F.col("of_b").alias("b"), "at", "n")
    rows, done = open_runs, []
    while size > 1:
        size = -(-size // CUT)
        cells = stored(_cells(rows, size, length), "suffix-cells")
        equal, going = _ranked(cells, "suffix-ranks")
        twice = equal.filter("copies > 1").select("a", "b")
        repeated = cells.filter("open").join(twice, ["a", "b"]).select("of_a", "of_b", "at", "n")
        found = found.union(stored(repeated, "suffix-parts"))
        if size > 1:
            left = going.select("a", "b", (F.col("copies") == 1).alias("single"))
            going_on = cells.join(left, ["a", "b"]).withColumn("open", F.col("open") & F.col("single"))
            # Of equal cells one is enough to compare with.
            closed = going_on.filter("NOT single").dropDuplicates(["a", "b"])
            last = rows
            rows = stored(going_on.filter("single").unionByName(closed).drop("single"), "suffix-rows")
            release(spark, last)
        release(spark, cells, equal)
        if rows.isEmpty():
            break
    return found


def repeated_spans(df: DataFrame, length: int = LENGTH, seed: int = SEED, text: str = "text") -> DataFrame:
    """`doc_id`, `key` (checksum of the text) and `spans`: start and end of each maximal repeated byte range in turn.

    Texts without a repeated string have no row.
    """
    if seed % 8 or seed > length:
        raise ValueError("seeds are a multiple of 8 bytes and no longer than the string")
    plain = df.select(df["doc_id"], df[text].alias("_text"))
    spark = df.sparkSession
    ranks = _seeds(plain, length, seed).groupBy("rank").agg(F.count(F.lit(1)).alias("n"))
    repeated = bloom(stored(ranks.filter("n > 1").select("rank"), "suffix-seeds"), "rank")
    # Three passes over the texts: the seeds, the names of runs of repeated seeds, and the bytes of
    # those runs that are neither unique nor settled.  Only what the last needs travels as bytes.
    kept = stored(_chosen_runs(plain, repeated, length, seed).drop("bytes"), "suffix-runs")
    release(spark)
    equal, going = _ranked(kept, "suffix-ranks")
    going = stored(going.select("a", "b", (F.col("copies") == 1).alias("open")), "suffix-going")
    data = _chosen_runs(plain, repeated, length, seed, bloom(going, "a")).dropDuplicates(["a", "b"])
    first = going.join(data, ["a", "b"]).select(
        F.col("a").alias("of_a"), F.col("b").alias("of_b"), "open", F.lit(0).cast("long").alias("at"), "n", "slot", "bytes"
    )
    first = stored(first, "suffix-rows")
    release(spark)
    whole = equal.filter("copies > 1").select("a", "b", F.lit(0).cast("long").alias("at"), F.lit(None).cast("long").alias("part"))
    parts = _settled_parts(first, length, seed).select("a", "b", "at", F.col("n").alias("part"))
    status = stored(whole.union(parts), "suffix-status")
    places = kept.select("doc_id", "key", "start", "n", "a", "b")
    ranges = places.join(status, ["a", "b"]).select(
        "doc_id", "key", (F.col("start") + F.col("at")).alias("start"), F.coalesce("part", "n").alias("n")
    )
    packed = F.col("start") * (1 << 16) + F.col("n")
    listed = ranges.groupBy("doc_id", "key").agg(F.collect_set(packed).alias("packed"))
    kind = df.schema["doc_id"].dataType.simpleString()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [maximal(np.array(x, np.int64), length) for x in batch.column("packed").to_pylist()]
            spans = pa.array(lists, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), spans], names=["doc_id", "key", "spans"])

    return listed.mapInArrow(merge, f"doc_id {kind}, key binary, spans array<long>")


def maximal(packed: np.ndarray, length: int) -> list[int]:
    """Starts and ends of the ranges that the packed runs of positions cover, those that touch made one."""
    packed = np.sort(packed)
    start, end = packed >> 16, (packed >> 16) + (packed & 0xFFFF) - 1 + length
    reach = np.maximum.accumulate(end)
    head = np.flatnonzero(np.concatenate(([True], start[1:] > reach[:-1])))
    tail = np.concatenate((head[1:] - 1, [len(start) - 1]))
    return np.stack((start[head], reach[tail]), axis=1).ravel().tolist()


def without_repeats(df: DataFrame, length: int = LENGTH, seed: int = SEED, text: str = "text") -> DataFrame:
    """`doc_id`, `n_bytes`, `spans` and `kept`, the bytes of each text outside of its repeated spans.

    A byte goes if a string of `length` bytes that covers it starts anywhere else, in this text or
    another; strings are those of the input.  A NULL text counts as empty; a shorter one has no
    string and stays.  Every row is a text of its own: of repeated rows all strings are repeated.  Ids
    may be NULL or the same for different texts; no column but the id and the text is read.
    """
    checked = df.select(df["doc_id"], df[text].alias("_text")).withColumn(
        "key", F.substring(F.unhex(F.sha2(F.coalesce("_text", F.lit("")).cast("binary"), 256)), 1, 16)
    )
    found = stored(repeated_spans(df, length, seed, text), "suffix-spans")
    release(df.sparkSession)
    found = found.select(F.col("doc_id").alias("of"), F.col("key").alias("of_key"), "spans")
    same = checked["doc_id"].eqNullSafe(found["of"]) & (checked["key"] == found["of_key"])
    kind = df.schema["doc_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                texts = utf8(part, "_text")
                spans = [x or [] for x in part.column("spans").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(t) for t in texts], pa.int64()),
                        pa.array(spans, pa.list_(pa.int64())),
                        pa.array([outside(t, s) for t, s in zip(texts, spans)], pa.binary()),
                    ],
                    names=["doc_id", "n_bytes", "spans", "kept"],
                )

    joined = checked.join(found, same, "left").select("doc_id", "_text", "spans")
    return joined.mapInArrow(cut, f"doc_id {kind}, n_bytes long, spans array<long>, kept binary")


def outside(data: bytes, spans: list[int]) -> bytes:
    edges = [0, *spans, len(data)]
    return b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))


def suffix_dedup_query(spark: SparkSession, folder: str) -> DataFrame:
    left = without_repeats(documents(spark, folder))
    return left.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).cast("long").alias("n_removed"),
        (F.size("spans") / 2).cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
