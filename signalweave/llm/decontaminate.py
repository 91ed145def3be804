"""Benchmark decontamination: which documents contain which test items, by MinHash containment search.

An item is contained in a document when at least a given share of its distinct word shingles occur
there.  Items are partitioned by size.  The MinHash sketch of an item is its shingles of least hash
(bottom-k); k belongs to the partition, one more than the largest item of it may lack.  A document that
contains an item lacks so few of its shingles that a known number of the sketch must be there; where
fewer are, the pair is no candidate.  A document is never sketched: next to a long document, the
signature of a short item would drown; its shingles probe the sketches.  Shingles that more than COMMON
items share enter a sketch last, whatever their hash, so that a phrase of many items and many documents
does not make candidates of all of them.  Candidates are verified by counting all shingles of the item
in the document.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from signalweave.llm.frames import documents, slices, stored, utf8

SHINGLE_WORDS = 5
THRESHOLD = 0.8
# A shingle of more items than this is the last to enter their sketches.
COMMON = 16
# Bits of the filter of all item shingles: its size is fixed, whatever the items are.
FILTER_BITS = 24

# ASCII marks separate words, as blanks do.
_BLANKED = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased words: runs of characters other than ASCII white space and marks."""
    return text.decode("utf-8").lower().encode("utf-8").translate(_BLANKED).split()


def shingle_keys(words: list[bytes], size: int) -> np.ndarray:
    """A 64-bit key for each run of `size` words, in order."""
    if len(words) < size:
        return np.empty(0, np.uint64)
    one = np.fromiter(map(zlib.crc32, words), np.uint64, len(words))
    key = np.full(len(words) - size + 1, size, np.uint64)
    for j in range(size):
        key = (key ^ one[j : len(words) - size + 1 + j]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key


def _mapped(df: DataFrame, schema: str, rows_of, id_name: str, text: str) -> DataFrame:
    """Rows of `rows_of(text)` under the id of the row and a number `row` that tells rows apart."""
    kind = df.schema[id_name].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for part in slices(batch, "_text"):
                at, found = [], []
                for i, own in enumerate(utf8(part, "_text")):
                    got = rows_of(own)
                    at += [i] * len(got)
                    found += got
                ids = part.column("_id").take(pa.array(at, pa.int64()))
                rows = pa.array(np.asarray(at, np.int64) + row, pa.int64())
                row += part.num_rows
                columns = list(zip(*found)) if found else [[] for _ in kinds]
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
                yield pa.RecordBatch.from_arrays([ids, rows, *arrays], names=names)

    kinds = {"shingle binary": [pa.binary()], "shingle binary, key long, n_shingles long": [pa.binary(), pa.int64(), pa.int64()]}[schema]
    names = [id_name, "row", *(f.split()[0] for f in schema.split(", "))]
    source = df.select(df[id_name].alias("_id"), df[text].alias("_text"))
    return source.mapInArrow(run, f"`{id_name}` {kind}, row long, {schema}")


def item_shingles(items: DataFrame, words: int = SHINGLE_WORDS, text: str = "text") -> DataFrame:
    """Distinct shingles of each item; an item of fewer words is one shingle of all of them."""

    def rows_of(own: bytes) -> list[tuple]:
        parts = words_of(own)
        size = min(words, len(parts))
        if not size:
            return []
        keys = shingle_keys(parts, size).view(np.int64).tolist()
        found = {b" ".join(parts[i : i + size]): key for i, key in enumerate(keys)}
        return [(shingle, key, len(found)) for shingle, key in found.items()]

    return _mapped(items, "shingle binary, key long, n_shingles long", rows_of, "item_id", text)


def sketches(shingles: DataFrame, threshold: float = THRESHOLD, common: int | None = COMMON) -> DataFrame:
    """`row`, `shingle`, `least`: the bottom-k MinHash sketch of each item, and how many of it a containing document holds.

    A partition holds the items of 2^c to 2^(c+1)-1 shingles and has one k, one more than the shingles
    that its largest item may lack.  Shingles of more than `common` items come last; None: by hash alone.
    """
    shared = shingles.groupBy("shingle").agg(F.count(F.lit(1)).alias("_shared"))
    late = F.lit(False) if common is None else F.col("_shared") > common
    rank = F.row_number().over(Window.partitionBy("row").orderBy(late, F.xxhash64("shingle"), "shingle"))
    partition = F.floor(F.log2(F.col("n_shingles")) + F.lit(1e-9))
    largest = F.pow(F.lit(2.0), partition + 1) - 1

    def lacking(n: Column) -> Column:
        return n - F.ceil(n * threshold - F.lit(1e-9))

    size = lacking(largest) + 1
    ranked = shingles.join(shared, "shingle").withColumn("_rank", rank)
    # An item of n shingles may lack fewer than the largest one; the rest of its sketch must be met.
    least = F.least(size, F.col("n_shingles")) - lacking(F.col("n_shingles"))
    return ranked.filter(F.col("_rank") <= size).select("row", "shingle", least.cast("long").alias("least"))


def candidates(hits: DataFrame, sketch: DataFrame) -> DataFrame:
    """`row`, `item_row` of documents that hold as much of an item's sketch as a containing document must."""
    probe = sketch.select(F.col("row").alias("item_row"), "shingle", "least")
    met = hits.join(probe, "shingle").groupBy("row", "item_row").agg(F.count(F.lit(1)).alias("met"), F.min("least").alias("least"))
    return met.filter("met >= least").select("row", "item_row")


def shingle_filter(shingles: DataFrame) -> np.ndarray:
    """A Bloom filter of all item shingles as 64-bit words: 2^FILTER_BITS bits, two per shingle.

    At most 2^(FILTER_BITS - 6) rows reach the driver.  A fuller filter lets more shingles through
    to the exact join and changes no result.
    """
    low = (1 << FILTER_BITS) - 1
    places = F.array(
        F.col("key").bitwiseAND(low), F.shiftrightunsigned("key", FILTER_BITS).bitwiseAND(low)
    )
    bits = shingles.select(F.explode(places).alias("place")).select(
        F.shiftright("place", 6).alias("word"),
        F.expr("shiftleft(1L, cast(place & 63 as int))").alias("bit"),
    )
    table = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    for row in bits.groupBy("word").agg(F.bit_or("bit").alias("bits")).collect():
        table[row["word"]] = np.uint64(row["bits"] & 0xFFFFFFFFFFFFFFFF)
    return table


def _held(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    low = np.uint64((1 << FILTER_BITS) - 1)
    held = np.ones(len(keys), bool)
    for place in (keys & low, (keys >> np.uint64(FILTER_BITS)) & low):
        held &= (table[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) != 0
    return held


def document_shingles(df: DataFrame, table: np.ndarray, sizes: list[int], text: str = "text") -> DataFrame:
    """Distinct shingles of each whole document that pass the filter; `sizes` are the lengths in words."""
    sent = df.sparkSession.sparkContext.broadcast(table)

    def rows_of(own: bytes) -> list[tuple]:
        parts = words_of(own)
        found = set()
        for size in sizes:
            held = np.flatnonzero(_held(sent.value, shingle_keys(parts, size)))
            found.update(b" ".join(parts[i : i + size]) for i in held.tolist())
        return [(shingle,) for shingle in sorted(found)]

    return _mapped(df, "shingle binary", rows_of, "doc_id", text)


def contained_items(
    df: DataFrame, items: DataFrame, words: int = SHINGLE_WORDS, threshold: float = THRESHOLD, text: str = "text"
) -> DataFrame:
    """`doc_id`, `item_id`, `n_shared`, `n_shingles`, `containment`, one row per document that contains an item.

    NULL and empty texts hold nothing and are held by nothing; so do texts without a word.  An item
    of fewer than `words` words is contained where all its words follow each other.  Every row is a
    document or an item of its own, so repeated rows give repeated pairs; NULL ids stay NULL.  Empty
    tables give no pair.  No column but the ids and the texts is read.
    """
    own = stored(item_shingles(items, words, text), "contamination-items")
    sketch = stored(sketches(own, threshold), "contamination-sketches")
    short = own.select(F.size(F.split(F.col("shingle").cast("string"), " ")).alias("size")).distinct()
    sizes = sorted(r["size"] for r in short.collect())
    hits = stored(document_shingles(df, shingle_filter(own), sizes, text), "contamination-hits")
    item = own.select(F.col("row").alias("item_row"), "item_id", "shingle", "n_shingles")
    shared = (
        candidates(hits, sketch)
        .join(item, "item_row")
        .join(hits, ["row", "shingle"])
        .groupBy("row", "item_row", "doc_id", "item_id", "n_shingles")
        .agg(F.count(F.lit(1)).alias("n_shared"))
    )
    enough = F.ceil(F.col("n_shingles") * threshold - F.lit(1e-9))
    return shared.filter(F.col("n_shared") >= enough).select(
        "doc_id", "item_id", "n_shared", "n_shingles", (F.col("n_shared") / F.col("n_shingles")).alias("containment")
    )


def without_contaminated(df: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of `df` whose id has no contained item; rows without an id go if any such row has one."""
    found = contained_items(df, items).select(F.col("doc_id").alias("_found")).distinct()
    return df.join(found, df["doc_id"].eqNullSafe(found["_found"]), "left_anti")


def rows_without_items(df: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of `df` that contain no item, whatever their ids: none, repeated or NULL.

    A row is named by its id and 128 bits of its text; rows equal in both hold the same items.
    """
    names = df.columns
    plain = df.toDF(*[f"_c{i}" for i in range(len(names))])
    doc, text = (F.col(f"_c{names.index(c)}") for c in ("doc_id", "text"))
    name = F.struct(doc.alias("id"), F.xxhash64(text).alias("h"), F.xxhash64(F.lit(1), text).alias("g"))
    found = contained_items(plain.select(name.alias("doc_id"), text.alias("text")), items)
    found = found.select(F.col("doc_id").alias("_found")).distinct()
    named = plain.withColumn("_name", name)
    left = named.join(found, named["_name"].eqNullSafe(found["_found"]), "left_anti")
    return left.drop("_name").toDF(*names)


def decontamination_query(spark: SparkSession, folder: str) -> DataFrame:
    return contained_items(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


# Words, distinct shingles and exact containment of every pair that shares a shingle.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, string_split_regex(trim(regexp_replace(lower(text), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+', ' ', 'g')), ' +') AS w
  FROM documents WHERE text IS NOT NULL),
i AS (
  SELECT item_id, string_split_regex(trim(regexp_replace(lower(text), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+', ' ', 'g')), ' +') AS w
  FROM benchmark WHERE text IS NOT NULL),
si AS (
  SELECT DISTINCT item_id, array_to_string(w[p : p + least(5, len(w)) - 1], ' ') AS s, least(5, len(w)) AS k
  FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS p FROM i WHERE w != [''])),
ks AS (SELECT DISTINCT k FROM si),
sd AS (
  SELECT DISTINCT doc_id, array_to_string(w[p : p + k - 1], ' ') AS s
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, ks WHERE len(w) >= k)),
n AS (SELECT item_id, count(*) AS n_shingles FROM si GROUP BY ALL),
c AS (SELECT doc_id, item_id, count(*) AS n_shared FROM sd JOIN si USING (s) GROUP BY ALL)
SELECT doc_id, item_id, n_shared, n_shingles, n_shared / n_shingles AS containment
FROM c JOIN n USING (item_id) WHERE n_shared >= ceil(n_shingles * 0.8 - 1e-9)
"""
