"""Ranked lexical search by pipelined term partitioning.

Terms of the query items are dealt to owners, the rarest to the first.  Every owner has the postings
of its terms, cut into slices of documents.  Bundles of items pass through the owners one after the
other: a stage cogroups the bundles' sparse accumulators with the owner's postings, adds integer
contributions, and hands the accumulators to the next stage; the best documents are picked at the end.

Between stages the tenth best sum so far of each item is known.  A document whose sum cannot reach
it even with the greatest contributions of all owners still to come cannot be in the result and leaves
the accumulators.  That changes no result, whatever the data.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from signalweave.llm.frames import documents, map_texts, release, slices, small, stored, utf8

TOP = 10
# Items of one bundle, documents of one slice, and the stages.
BUNDLE = 256
SLICE_BITS = 14
OWNERS = 4
# Query items are taken in blocks of so many terms in all, or of one item.
BLOCK_TERMS = 200_000

# Term characters to themselves, A-Z lower-cased, all other ASCII to blanks.
_TERM_BYTES = bytes(
    c | 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TERM_BYTES).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _blocks(items: DataFrame, text: str) -> Iterator[list[tuple[object, list[bytes]]]]:
    """The query items with their distinct terms, in blocks that the driver can hold."""
    block, total = [], 0
    for row in items.select(items["item_id"].alias("item_id"), items[text].alias("text")).toLocalIterator():
        terms = sorted(set(terms_of((row["text"] or "").encode())))
        if block and total + len(terms) > BLOCK_TERMS:
            yield block
            block, total = [], 0
        block.append((row["item_id"], terms))
        total += len(terms)
    if block:
        yield block


def term_counts(df: DataFrame, numbers: dict[bytes, int], text: str = "text") -> DataFrame:
    """`doc_id`, `n` (terms with repeats), `terms` and `tfs` (the numbered terms in the text) per row."""
    sent = df.sparkSession.sparkContext.broadcast(numbers)

    def values():
        known = sent.value

        def of(texts):
            lengths, terms, tfs = [], [], []
            for one in texts:
                words = terms_of(one)
                found = Counter(words)
                # Look up the fewer: the text's distinct terms or the query's.
                common = found.keys() & known.keys()
                lengths.append(len(words))
                terms.append([known[t] for t in common])
                tfs.append([found[t] for t in common])
            yield pa.array(lengths, pa.int64())
            yield pa.array(terms, pa.list_(pa.int32()))
            yield pa.array(tfs, pa.list_(pa.int32()))

        return of

    return map_texts(df, "n long, terms array<int>, tfs array<int>", values, text)


def _slice_postings(n_docs: int, n_terms: int):
    """Turns the rows of one slice into a row for each term: its documents by place, and their contributions
    for a weight of one; documents are placed by id, NULL last."""

    def one(key: tuple, table: pa.Table) -> pa.Table:
        part = table.to_pandas(integer_object_nulls=True)
        part["missing"] = part["doc_id"].isna()
        part = part.sort_values(["missing", "doc_id"], kind="stable", ignore_index=True)
        sizes = part["terms"].map(len).to_numpy()
        term = np.concatenate([*part["terms"], np.zeros(0, np.int32)]).astype(np.int64)
        tf = np.concatenate([*part["tfs"], np.zeros(0, np.int32)]).astype(np.int64)
        place = np.repeat(np.arange(len(part), dtype=np.int32), sizes)
        # Python integers where the product may pass 64 bits.
        m = np.array([10 + 90 * int(n) * n_docs // n_terms for n in part["n"]], np.int64)
        impact = 1_000_000_000 * tf // (1000 * tf + 8 * m[place])
        order = np.argsort(term, kind="stable")
        term, place, impact = term[order], place[order], impact[order].astype(np.int32)
        starts = np.flatnonzero(np.r_[True, term[1:] != term[:-1]]) if len(term) else np.zeros(0, int)
        ends = np.r_[starts[1:], len(term)]
        return pa.table(
            {
                "slice": pa.array([key[0].as_py()] * len(starts), pa.int64()),
                "term": pa.array(term[starts], pa.int32()),
                "df": pa.array(ends - starts, pa.int64()),
                "most": pa.array([int(impact[a:b].max()) for a, b in zip(starts, ends)], pa.int64()),
                "places": pa.array([place[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                "impacts": pa.array([impact[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
            }
        )

    return one


def postings(counts: DataFrame, n_docs: int, n_terms: int) -> DataFrame:
    """The inverted index of the query's terms: `slice`, `term`, `df`, `most`, `places`, `impacts`.

    A contribution of 10**9 * tf div (1000 * tf + 8 * m) is below 10**6 and does not depend on the item.
    """
    made = "slice long, term int, df long, most long, places binary, impacts binary"
    return counts.groupBy("slice").applyInArrow(_slice_postings(n_docs, n_terms), made)


def _owners(df_of: dict[int, int], owners: int) -> dict[int, int]:
    """Terms to owners, the rarest first, each owner with about the same number of postings."""
    total, seen, dealt = sum(df_of.values()), 0, {}
    for term, df in sorted(df_of.items(), key=lambda x: (x[1], x[0])):
        dealt[term] = min(owners - 1, owners * seen // max(1, total))
        seen += df
    return dealt


def _stage(needed, last: bool, top: int):
    """One owner's work on one bundle and slice: add contributions, keep what may still win.

    `needed` has, per item, the least sum that a document must have after this stage.
    """

    def one(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        slice_, bundle = (k.as_py() for k in key)
        least = needed.value
        sums: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for item, places, scores in zip(*(left.column(c).to_pylist() for c in ("item", "places", "scores"))):
            sums.setdefault(item, []).append((np.frombuffer(places, np.int32), np.frombuffer(scores, np.int64)))
        for places, impacts, w, items in zip(
            *(right.column(c).to_pylist() for c in ("places", "impacts", "weight", "items"))
        ):
            at, gain = np.frombuffer(places, np.int32), np.frombuffer(impacts, np.int32).astype(np.int64) * w
            for item in items:
                sums.setdefault(item, []).append((at, gain))
        dense = np.zeros(1 << SLICE_BITS, np.int64)
        out = {"item": [], "places": [], "scores": [], "best": []}
        for item, parts in sums.items():
            dense[:] = 0
            for at, gain in parts:  # the places of one part are distinct
                dense[at] += gain
            kept = np.flatnonzero(dense >= max(1, least[item]))
            score = dense[kept]
            if len(kept) > top:
                best = np.partition(score, len(score) - top)[-top:]
                if last:  # places follow ids, so a stable sort settles ties
                    order = np.argsort(-score, kind="stable")[:top]
                    kept, score = kept[order], score[order]
            else:
                best = score
            if len(kept):
                out["item"].append(item)
                out["places"].append(kept.astype(np.int32).tobytes())
                out["scores"].append(score.tobytes())
                out["best"].append(best)
        n = len(out["item"])
        return pa.table(
            {
                "slice": pa.array([slice_] * n, pa.int64()),
                "bundle": pa.array([bundle] * n, pa.int32()),
                "item": pa.array(out["item"], pa.int32()),
                "places": pa.array(out["places"], pa.binary()),
                "scores": pa.array(out["scores"], pa.binary()),
                "best": pa.array(out["best"], pa.list_(pa.int64())),
            }
        )

    return one


_CARRIED = "slice long, bundle int, item int, places binary, scores binary, best array<long>"


def _tenth(carried: DataFrame, top: int) -> dict[int, int]:
    """Per item the `top`-th best sum so far, for items with so many documents: one number an item."""
    sums = carried.select("item", F.explode("best").alias("best"))
    ranked = sums.withColumn("r", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("best"))))
    return {r["item"]: r["best"] for r in ranked.filter(F.col("r") <= top).filter(F.col("r") == top).collect()}


def _block_ranking(
    docs: DataFrame, block: list[tuple[object, list[bytes]]], items: DataFrame, top: int, owners: int, text: str
) -> DataFrame | None:
    spark = docs.sparkSession
    vocabulary = sorted({t for _, terms in block for t in terms})
    numbers = {t: i for i, t in enumerate(vocabulary)}
    place = F.monotonically_increasing_id()
    # Written once: partition and row number name a row from here on, and slices are runs of rows.
    counts = stored(term_counts(docs, numbers, text).withColumn("row", place), "search-counts")
    counts = counts.withColumn("slice", F.shiftright("row", SLICE_BITS))
    n_docs, n_terms = counts.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not n_docs or not vocabulary:
        return None
    index = stored(postings(counts.select("slice", "doc_id", "n", "terms", "tfs"), n_docs, n_terms), "search-index")
    # One row per term of the block, whose number is bounded.
    stats = index.groupBy("term").agg(F.sum("df").alias("df"), F.max("most").alias("most")).collect()
    weights = {r["term"]: weight(n_docs, r["df"]) for r in stats}
    most = {r["term"]: weights[r["term"]] * r["most"] for r in stats}
    owner = _owners({r["term"]: r["df"] for r in stats if weights[r["term"]]}, owners)
    of_item = [[numbers[t] for t in terms if numbers[t] in owner] for _, terms in block]
    holders: dict[tuple[int, int], list[int]] = {}
    for i, own in enumerate(of_item):
        for t in own:
            holders.setdefault((t, i // BUNDLE), []).append(i)
    rows = [(t, owner[t], b, weights[t], found) for (t, b), found in holders.items()]
    dealt = spark.createDataFrame(rows, "term int, owner int, bundle int, weight long, items array<int>")
    carried = spark.createDataFrame([], _CARRIED)
    tenth: dict[int, int] = {}
    for stage in range(owners):
        # What all later owners can add at most, for each item.
        rest = [sum(most[t] for t in own if owner[t] > stage) for own in of_item]
        needed = spark.sparkContext.broadcast([tenth.get(i, 0) - rest[i] for i in range(len(block))])
        mine = index.join(small(dealt.filter(F.col("owner") == stage)), "term").select(
            "slice", "bundle", "places", "impacts", "weight", "items"
        )
        work = _stage(needed, stage == owners - 1, top)
        by = "slice", "bundle"
        before = carried
        carried = stored(carried.groupBy(*by).cogroup(mine.groupBy(*by)).applyInArrow(work, _CARRIED), "search-stage")
        if stage:
            release(spark, before)
        tenth = _tenth(carried, top)
    # Ten places at most of an item and slice are left; places become ids again.
    unpacked = _unpack(carried.select("slice", "item", "places", "scores"))
    ids = Window.partitionBy("slice").orderBy(F.col("doc_id").asc_nulls_last(), "row")
    placed = counts.select("slice", "doc_id", "row").join(small(unpacked.select("slice").distinct()), "slice", "left_semi")
    placed = placed.withColumn("place", F.row_number().over(ids) - 1).select("slice", "doc_id", "place")
    best = unpacked.join(placed, ["slice", "place"])
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    kind = items.schema["item_id"].dataType
    names = spark.createDataFrame(
        [(i, item) for i, (item, _) in enumerate(block)], f"item int, item_id {kind.simpleString()}"
    )
    return ranked.join(small(names), "item").select("item_id", "rank", "doc_id", "score")


def _unpack(df: DataFrame) -> DataFrame:
    """One row per document of the carried accumulators."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            found = [np.frombuffer(p, np.int32) for p in part["places"]]
            sizes = [len(p) for p in found]
            yield pd.DataFrame(
                {
                    "slice": np.repeat(part["slice"].to_numpy(), sizes),
                    "item": np.repeat(part["item"].to_numpy(), sizes),
                    "place": np.concatenate([*found, np.zeros(0, np.int32)]),
                    "score": np.concatenate([*(np.frombuffer(s, np.int64) for s in part["scores"]), np.zeros(0, np.int64)]),
                }
            )

    return df.mapInPandas(run, "slice long, item int, place int, score long")


def ranked_search(
    docs: DataFrame, items: DataFrame, top: int = TOP, owners: int = OWNERS, text: str = "text"
) -> DataFrame:
    """The `top` documents of `docs` (`doc_id` and text) for every row of `items` (`item_id`, `text`).

    Returns `item_id`, `rank` from 1, `doc_id`, `score`.  Equal scores are ranked by id, a NULL id last.
    Every row of either table counts by itself: rows of one document id may both be found, items of
    one id have their own ranks.  A NULL text has no terms; such an item, one whose terms are in no or
    in nearly all documents (weight 0), and an empty table give no rows.  Texts of any length count whole.
    """
    found = None
    for block in _blocks(items, "text"):
        one = _block_ranking(docs, block, items, top, owners, text)
        if one is not None:
            found = one if found is None else found.unionByName(one)
    if found is None:
        kind = items.schema["item_id"].dataType.simpleString()
        ids = docs.schema["doc_id"].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id {ids}, score long")
    return found


def search_query(spark: SparkSession, folder: str) -> DataFrame:
    found = ranked_search(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))
    return found.withColumn("rank", F.col("rank").cast("int"))


ORACLE = r"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
d AS (SELECT r, doc_id, len(w)::BIGINT AS n, w FROM t WHERE len(w) > 0),
s AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS ll FROM d),
p AS (SELECT r, doc_id, n, w, count(*)::BIGINT AS tf FROM (SELECT r, doc_id, n, unnest(w) AS w FROM d) GROUP BY ALL),
f AS (SELECT w, count(*)::BIGINT AS df FROM p GROUP BY w),
i AS (SELECT row_number() OVER () AS i, item_id, text FROM benchmark),
q AS (
  SELECT DISTINCT i, item_id, w
  FROM (SELECT i, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS w FROM i)),
g AS (SELECT i, item_id, w, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS weight FROM q JOIN f USING (w), s),
c AS (
  SELECT i, item_id, r, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // ll))))::BIGINT AS score
  FROM g JOIN p USING (w), s GROUP BY ALL)
SELECT item_id, (row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST))::INTEGER AS rank, doc_id, score
FROM c WHERE score > 0
QUALIFY rank <= 10
"""
