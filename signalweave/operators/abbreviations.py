"""Abbreviations learnt from a corpus without labels, for sentences that are not cut after them.

A word that is followed by a period far more often than chance would have it is an abbreviation, the more so the
shorter it is and the more periods it has inside (the log-likelihood criterion of Kiss and Strunk, 2006).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalweave.operators.once import explode_once

# The criterion's share of periods after an abbreviation, and its threshold.
CERTAIN = 0.99
THRESHOLD = 0.3
# Words seen less often are not judged, and no more abbreviations are kept than this.
LEAST = 5
MOST = 2_000

OPENING = r"""["'(\[]*"""
CLOSING = r"""["',;:!?)\]]*"""
TOKEN = rf"^{OPENING}(\p{{L}}+(?:\.\p{{L}}+)*)(\.?){CLOSING}$"


def word_periods(docs: DataFrame, text: str = "text") -> DataFrame:
    """`word` (lowered), how often it occurs (`n`) and how often a period follows it (`k`)."""
    tokens = explode_once(docs.select(F.col(text).alias("_text")), "token", F.split(F.col("_text"), r"\s+"))
    words = tokens.select(
        F.lower(F.regexp_extract("token", TOKEN, 1)).alias("word"), (F.regexp_extract("token", TOKEN, 2) == ".").alias("dot")
    )
    return words.filter("word != ''").groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.count_if("dot").alias("k"))


def abbreviation_scores(docs: DataFrame, text: str = "text") -> DataFrame:
    """`word`, `n`, `k` and `score` of every word that is judged; an abbreviation has THRESHOLD or more."""
    counts = word_periods(docs, text)
    totals = counts.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    if not totals["n"]:
        return counts.withColumn("score", F.lit(0.0))
    # Away from 0 and 1, where a logarithm has no value.
    share = min(max(totals["k"] / totals["n"], 1e-9), 1 - 1e-9)
    k, rest = F.col("k"), F.col("n") - F.col("k")
    ratio = 2 * (k * (F.log(F.lit(CERTAIN)) - F.log(F.lit(share))) + rest * (F.log(F.lit(1 - CERTAIN)) - F.log(F.lit(1 - share))))
    inner = F.char_length("word") - F.char_length(F.replace("word", F.lit("."), F.lit("")))
    letters = F.char_length("word") - inner
    # The number of occurrences without a period counts against longer words.
    score = ratio * F.exp(-letters) * (inner + 1) * F.pow(letters.cast("double"), -rest.cast("double"))
    return counts.filter((F.col("n") >= LEAST) & (k > 0)).withColumn("score", F.round(score, 9))


def learn_abbreviations(docs: DataFrame, text: str = "text", most: int = MOST) -> list[str]:
    """The abbreviations of the corpus, the best `most` of them, in alphabetical order."""
    good = abbreviation_scores(docs, text).filter(F.col("score") >= THRESHOLD)
    return sorted(r["word"] for r in good.orderBy(F.desc("score"), "word").limit(most).select("word").collect())
