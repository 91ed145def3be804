"""Quality classifier: supervised subword embeddings.

A document is the mean of learned vectors of its words and of their character n-grams, hashed to a
table of fixed size; a softmax over that mean gives the quality.  Vectors and output weights are
trained together by stochastic gradient descent in numpy.  As the softmax is linear in the mean, a
trained model is scored with one number per table row.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalweave.llm import labelled
from signalweave.llm.frames import documents, map_texts, stored

FOLDS, HELD_OUT = 3, 1
HASH_BITS = 16
WIDTH = 8
GRAMS = (2, 3, 4)
ROUNDS = 8
RATE = 8.0
CACHED = 200_000
#: A word that repeats the one before it is a feature of its own, as words of later texts are unseen.
#: Without it, a mean of n-gram vectors takes a text of one unseen word for a good one.
REPEAT = 0
# A longer run without blanks counts as words of this many bytes; so many words are worked on at a time.
LONGEST_WORD, PIECE_WORDS = 1024, 2000

_WORD = re.compile(rb"\S{1,%d}" % LONGEST_WORD)


def grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Table rows of all features of the words, and the index of the word that each belongs to.

    The features of a word are the word itself and the character n-grams of "<word>".
    """
    padded = [b"<" + w + b">" for w in words]
    units = np.frombuffer(b"".join(padded), np.uint8).astype(np.uint64)
    sizes = np.fromiter(map(len, padded), np.int64, len(padded))
    owner = np.repeat(np.arange(len(words)), sizes)
    mix = np.uint64(0x9E3779B97F4A7C15)
    whole = np.fromiter(map(zlib.crc32, words), np.uint64, len(words)) * mix
    keys, owners = [whole], [np.arange(len(words))]
    for n in GRAMS:
        if len(units) < n:
            continue
        key = np.full(len(units) - n + 1, n, np.uint64)
        for j in range(n):
            key = key * np.uint64(1_000_003) + units[j : len(units) - n + 1 + j]
        inside = owner[: len(key)] == owner[n - 1 :]
        keys.append(key[inside] * mix)
        owners.append(owner[: len(key)][inside])
    rows = (np.concatenate(keys) >> np.uint64(64 - HASH_BITS)).astype(np.int64)
    return np.maximum(rows, 1), np.concatenate(owners)


def pieces(text: bytes) -> Iterator[tuple[list[bytes], int]]:
    """The words of a text, a bounded number of bounded words at a time, and how many repeat the word before."""
    words = (found[0] for found in _WORD.finditer(text))
    last = b""
    while some := list(islice(words, PIECE_WORDS)):
        yield some, sum(map(bytes.__eq__, [last, *some], some))
        last = some[-1]


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct table rows of a text and how often each occurs."""
    at, n = np.empty(0, np.int64), np.empty(0, np.int64)
    for words, again in pieces(text):
        rows = np.concatenate((grams(words)[0], np.full(4 * again, REPEAT)))
        own, count = np.unique(rows, return_counts=True)
        if len(at):
            both = np.bincount(at, n, 1 << HASH_BITS) + np.bincount(own, count, 1 << HASH_BITS)
            own = np.flatnonzero(both)
            count = both[own].astype(np.int64)
        at, n = own, count
    return at, n


def packed(at: np.ndarray, n: np.ndarray) -> bytes:
    """Ascending table rows as steps of 16 bits, and their counts, as compressed planes of bytes."""
    steps = np.diff(at, prepend=0).astype("<u2").view(np.uint8).reshape(-1, 2)
    counts = n.astype("<u4").view(np.uint8).reshape(-1, 4)
    return zlib.compress(steps.T.tobytes() + counts.T.tobytes(), 1)


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(6, -1)
    steps = np.ascontiguousarray(planes[:2].T).view("<u2").ravel()
    counts = np.ascontiguousarray(planes[2:].T).view("<u4").ravel()
    return np.cumsum(steps, dtype=np.int64), counts.astype(np.float32)


def pass_over(model: np.ndarray, rows: pd.DataFrame, step: int) -> np.ndarray:
    """One pass of gradient descent.  The last two table rows hold the output weights and biases."""
    vectors, out, bias = model[:-3], model[-3:-1], model[-1, :2]
    rate = RATE / (1 + step)
    for data, label in zip(rows["packed"], rows["label"]):
        at, n = unpacked(data)
        share = n / max(1.0, n.sum())
        mean = share @ vectors[at] if len(at) else np.zeros(WIDTH, np.float32)
        logits = out @ mean + bias
        odds = np.exp(logits - logits.max())
        error = odds / odds.sum()
        error[int(label)] -= 1.0
        back = error @ out
        out -= rate * 0.1 * np.outer(error, mean)
        bias -= rate * 0.01 * error
        vectors[at] -= rate * share[:, None] * back
    return model


def train(rows: DataFrame, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """A score per table row and a bias, learnt from `doc_id`, `text`, `label`, `shard`; each row counts, also of one id."""

    def values():
        def columns(texts: list[bytes]):
            yield pa.array([packed(*features(t)) for t in texts], pa.binary())

        return columns

    known = map_texts(rows, "packed binary", values, keep=("doc_id", "label", "shard"))
    known = stored(known, "quality")
    start = np.random.default_rng(7).uniform(-0.5, 0.5, ((1 << HASH_BITS) + 3, WIDTH)).astype(np.float32)
    start[:-3] /= WIDTH
    start[-1] = 0
    model = labelled.mixed(known, start, pass_over, rounds)
    out, bias = model[-3:-1].astype(np.float64), model[-1, :2].astype(np.float64)
    return model[:-3] @ (out[1] - out[0]), float(bias[1] - bias[0])


def score(
    df: DataFrame, table: np.ndarray, bias: float, keep: tuple[str, ...] = ("doc_id",), text: str = "text"
) -> DataFrame:
    """The kept columns and `score`, the probability that a text is of good quality.

    A NULL or empty text has only the bias.  Rows are independent; no column but the text is read.
    The broadcast table has a fixed number of rows; the cache of words is bounded.  A text of any
    length is read whole, in pieces; more than LONGEST_WORD bytes without a blank are several words.
    """
    sent = df.sparkSession.sparkContext.broadcast((table, bias))

    def values() -> Callable:
        table, bias = sent.value
        known: dict[bytes, tuple[float, int]] = {}

        def learn(words: list[bytes]) -> None:
            if len(known) > CACHED:
                known.clear()
            rows, owner = grams(words)
            sums = np.bincount(owner, table[rows], len(words)).tolist()
            counts = np.bincount(owner, minlength=len(words)).tolist()
            known.update(zip(words, zip(sums, counts)))

        def one(text: bytes) -> float:
            total = count = 0.0
            for some, again in pieces(text):
                new = {w for w in some if w not in known}
                if new:
                    if len(known) + len(new) > CACHED:
                        known.clear()
                        new = set(some)
                    learn(list(new))
                got = np.array([known[w] for w in some])
                total += got[:, 0].sum() + 4 * again * table[REPEAT]
                count += got[:, 1].sum() + 4 * again
            return bias + (total / count if count else 0.0)

        def column(texts: list[bytes]):
            logits = np.array([one(t) for t in texts])
            yield pa.array(1.0 / (1.0 + np.exp(-np.clip(logits, -35, 35))))

        return column

    return map_texts(df, "score double", values, text, keep)


def quality_query(spark: SparkSession, folder: str) -> DataFrame:
    model = train(labelled.training_rows(spark, folder, "quality", FOLDS, HELD_OUT))
    scored = score(documents(spark, folder), *model)
    held_out = F.coalesce(labelled.fold("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
