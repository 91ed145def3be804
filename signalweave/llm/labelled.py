"""Labelled training rows, and models of fixed size trained over shards of them.

Training reads a sample of the labelled rows whose expected size is bounded by a parameter; it is
spread over a fixed number of shards.  In each round every shard starts from the common model and
passes over its rows once; the shards' models, arrays of fixed size, are averaged.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalweave.llm.frames import documents, release, small

# Bound of the training sample (expected rows) and the number of shards that it is dealt to.
SAMPLE_ROWS = 12_000
SHARDS = 4


def fold(doc_id: Column | str, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; NULL for a NULL id."""
    key = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(key.cast("string").cast("binary")) % folds


def training_rows(
    spark: SparkSession, folder: str, label: str, folds: int, held_out: int, bound: int = SAMPLE_ROWS
) -> DataFrame:
    """`doc_id`, `text`, `label`, `shard` of labelled documents outside the held-out fold.

    Rows are chosen by a hash of the id, at a rate that makes `bound` of them expected at most.
    """
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    known = labels.filter(F.col(label).isNotNull() & (fold("doc_id", folds) != held_out))
    rate = min(1.0, bound / max(1, known.count()))
    draw = F.pmod(F.xxhash64(F.lit(label), "doc_id"), F.lit(1_000_000))
    chosen = known.filter(draw < round(rate * 1_000_000)).select("doc_id", F.col(label).alias("label"))
    shard = F.pmod(F.xxhash64(F.lit("shard"), "doc_id"), F.lit(SHARDS)).cast("int")
    texts = documents(spark, folder).select("doc_id", "text")
    return texts.join(small(chosen), "doc_id").withColumn("shard", shard)


def mixed(
    rows: DataFrame,
    start: np.ndarray,
    train: Callable[[np.ndarray, pd.DataFrame, int], np.ndarray],
    rounds: int,
) -> np.ndarray:
    """The model after `rounds` rounds of training shards in parallel and averaging their models.

    `rows` has `shard` and `doc_id`.  No rows give the starting model.
    """
    spark = rows.sparkSession
    model = start
    for step in range(rounds):
        sent = spark.sparkContext.broadcast(_packed(model))
        one = _shard_pass(sent, train, start.dtype, start.shape, step)
        got = rows.groupBy("shard").applyInPandas(one, "n long, model binary").collect()
        sent.unpersist()
        release(spark)
        if got:
            count = sum(r["n"] for r in got)
            model = np.zeros_like(start)
            while got:
                part = got.pop()
                model += _unpacked(part["model"], start.dtype, start.shape) * start.dtype.type(part["n"] / count)
    return model


def _packed(model: np.ndarray) -> bytes:
    return zlib.compress(model.tobytes(), 1)


def _unpacked(data: bytes, kind: np.dtype, shape: tuple[int, ...]) -> np.ndarray:
    return np.frombuffer(zlib.decompress(bytes(data)), kind).reshape(shape).copy()


def _shard_pass(sent, train: Callable, kind: np.dtype, shape: tuple[int, ...], step: int) -> Callable:
    def one(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("doc_id", kind="stable", ignore_index=True)
        order = np.random.default_rng(step).permutation(len(part))
        own = train(_unpacked(sent.value, kind, shape), part.iloc[order], step)
        return pd.DataFrame({"n": [len(part)], "model": [_packed(own)]})

    return one
