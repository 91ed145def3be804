"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Every coordinate has a learning rate of its own and an L1 penalty, so that most weights are exactly
zero; what is broadcast for scoring is the short list of the others.  The penalty and the rarity of
toxic texts pull all scores down, so a fold that has no part in the weights sets scale and bias.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalweave.llm import labelled
from signalweave.llm.frames import documents, map_texts, stored

FOLDS, HELD_OUT = 5, 0
HASH_BITS = 19
SKIPS = 2
ALPHA, BETA, L1, L2 = 1.0, 1.0, 2.0, 0.1
ROUNDS = 4
# Of the folds that may be learnt from, the one that sets the decision and has no part in the weights.
CALIBRATION = 1

_MARKS = re.compile(r"[^\w\s]+")


def words_of(text: bytes) -> np.ndarray:
    """32-bit hashes of the lower-cased words of a text, punctuation taken as blanks."""
    plain = _MARKS.sub(" ", text.decode("utf-8").lower()).encode("utf-8")
    parts = plain.split()
    return np.fromiter(map(zlib.crc32, parts), np.uint64, len(parts))


def features(words: np.ndarray, skips: int = SKIPS) -> np.ndarray:
    """Hashed coordinates of the words, the word pairs and the pairs with up to `skips` words between."""
    mix = np.uint64(0x9E3779B97F4A7C15)
    found = [words * mix]
    for gap in range(1, skips + 2):
        if len(words) > gap:
            pair = words[:-gap] * np.uint64(0xC2B2AE3D27D4EB4F) + words[gap:]
            kind = 1 if gap == 1 else 2  # a skip-gram is the same whatever the gap
            found.append((pair * np.uint64(0x165667B19E3779F9) + np.uint64(kind)) * mix)
    return (np.concatenate(found) >> np.uint64(64 - HASH_BITS)).astype(np.int32)


def weights_of(model: np.ndarray) -> np.ndarray:
    """FTRL-proximal weights of the accumulators z (row 0) and n (row 1); the last one is the bias."""
    z, n = model
    w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
    w[np.abs(z) <= L1] = 0.0
    return w


def probability(score: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(score, -35, 35)))


def pass_over(model: np.ndarray, rows: pd.DataFrame, step: int) -> np.ndarray:
    """One pass of FTRL-proximal over the rows, each a list of distinct coordinates and a label."""
    z, n = model
    for at, label in zip(rows["at"], rows["label"]):
        at = np.append(np.asarray(at, np.int64), len(z) - 1)
        zi, ni = z[at], n[at]
        w = -(zi - np.sign(zi) * L1) / ((BETA + np.sqrt(ni)) / ALPHA + L2)
        w[np.abs(zi) <= L1] = 0.0
        g = float(probability(np.array(w.sum()))) - float(label)
        more = np.sqrt(ni + g * g)
        z[at] = zi + g - (more - np.sqrt(ni)) / ALPHA * w
        n[at] = ni + g * g
    return model


def calibration(logits: np.ndarray, labels: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Scale and shift that turn logits into log-odds; a label weighs as the root of how many rows it has.

    A logistic fit by Newton steps.  Its targets are a little inside of 0 and 1, so that labels that
    the logits separate have a finite fit.  Without rows of both labels nothing is changed.
    """
    toxic = np.asarray(labels) == 1
    n1, n0 = int(toxic.sum()), int((~toxic).sum())
    if not n1 or not n0:
        return 1.0, 0.0
    target = np.where(toxic, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(toxic, n1**-0.5, n0**-0.5) / (n1**0.5 + n0**0.5)
    middle, spread = float(np.mean(logits)), float(np.std(logits)) or 1.0
    x = np.column_stack(((logits - middle) / spread, np.ones(len(logits))))
    fit = np.zeros(2)

    def loss(fit: np.ndarray) -> float:
        z = x @ fit
        return float(weight @ (np.logaddexp(0, z) - target * z))

    for _ in range(steps):
        odds = probability(x @ fit)
        slope = x.T @ (weight * (odds - target))
        curve = (x.T * (weight * odds * (1 - odds))) @ x + 1e-9 * np.eye(2)
        move, size = np.linalg.solve(curve, slope), 1.0
        while size > 1e-6 and loss(fit - size * move) > loss(fit):
            size /= 2
        fit = fit - size * move
    if fit[0] <= 0:  # logits that say nothing keep their order
        return 1.0, 0.0
    return float(fit[0] / spread), float(fit[1] - fit[0] * middle / spread)


def calibrated(rows: DataFrame, at: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The weights, scaled, and the bias, shifted, by labelled `rows` (`text`, `label`) of a bounded sample."""
    got = score(rows, at, w, keep=("label",)).collect()
    odds = np.clip(np.array([r["score"] for r in got]), 1e-15, 1 - 1e-15)
    scale, shift = calibration(np.log(odds / (1 - odds)), np.array([r["label"] for r in got]))
    last = 1 << HASH_BITS
    if last not in at:
        at, w = np.append(at, last), np.append(w, 0.0)
    w = w * scale
    w[at == last] += shift
    return at, w


def train(rows: DataFrame, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Coordinates and weights that are not zero, learnt from `doc_id`, `text`, `label`, `shard`."""

    def values():
        def column(texts: list[bytes]):
            yield pa.array([np.unique(features(words_of(t))) for t in texts], pa.list_(pa.int32()))

        return column

    known = stored(map_texts(rows, "at array<int>", values, keep=("doc_id", "label", "shard")), "toxicity")
    start = np.zeros((2, (1 << HASH_BITS) + 1), np.float32)
    w = weights_of(labelled.mixed(known, start, pass_over, rounds).astype(np.float64))
    at = np.flatnonzero(w)
    return at, w[at]


def score(df: DataFrame, at: np.ndarray, w: np.ndarray, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """The kept columns and `score`, the probability that a text is toxic.

    A NULL or empty text has only the bias.  Rows are independent; no column but the text is read.
    The broadcast holds the non-zero weights, at most one per hash value.
    """
    sent = df.sparkSession.sparkContext.broadcast((at.astype(np.int32), w.astype(np.float64)))

    def values() -> Callable:
        at, w = sent.value
        table = np.zeros((1 << HASH_BITS) + 1)
        table[at] = w
        bias = table[-1]
        used = table != 0

        def one(text: bytes) -> float:
            # Each coordinate counts once; only those with a weight need to be told apart.
            found = features(words_of(text))
            found = np.unique(found[used[found]])
            return bias + table[found].sum()

        def column(texts: list[bytes]):
            yield pa.array(probability(np.array([one(t) for t in texts])))

        return column

    return map_texts(df, "score double", values, text, keep)


def toxicity_query(spark: SparkSession, folder: str) -> DataFrame:
    rows = labelled.training_rows(spark, folder, "toxic", FOLDS, HELD_OUT)
    aside = labelled.fold("doc_id", FOLDS) == CALIBRATION
    model = calibrated(rows.filter(aside), *train(rows.filter(~aside)))
    scored = score(documents(spark, folder), *model)
    held_out = F.coalesce(labelled.fold("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
