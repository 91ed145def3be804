"""Keyword dummies, AND-combined keys and the two-theme filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalweave.functions.matching import find_all, no_strings
from signalweave.functions.patterns import word_pattern
from signalweave.operators.enrich import clip_to_one
from signalweave.operators.once import computed_once
from signalweave.sources.dictionaries import AndKeys

HITS = "hits"
MIN_LENGTH = 5


def long_enough(text: str = "text", minimum: int = MIN_LENGTH) -> Column:
    return F.length(text) > minimum


def add_hits(df: DataFrame, keys: AndKeys, text: str = "text", column: str = HITS) -> DataFrame:
    """Add the ARRAY of search words in the lowered text, followed by the AND keys they satisfy.

    AND keys are a short literal array of structs: adding keys does not add plan nodes.
    """
    pattern = word_pattern(keys.search_words, plural=False)
    searched = computed_once(df, _words=F.array_distinct(find_all(F.lower(text), pattern)))
    if not keys.combined:
        return searched.withColumnRenamed("_words", column)
    table = F.array(
        *[
            F.struct(F.lit(key).alias("key"), F.array(*map(F.lit, parts)).alias("parts"))
            for key, parts in keys.combined.items()
        ]
    )
    satisfied = F.filter(
        table, lambda k: F.forall(k["parts"], lambda part: F.array_contains("_words", part))
    )
    combined = F.when(F.size("_words") > 1, F.transform(satisfied, lambda k: k["key"]))
    return searched.withColumn(
        column, F.concat("_words", F.coalesce(combined, no_strings()))
    ).drop("_words")


def theme_tag(keywords: Sequence[str], hits: str = HITS) -> Column:
    """1 where one of the theme's keywords (plain or combined) was hit."""
    words = F.array(*map(F.lit, keywords)) if keywords else no_strings()
    return F.coalesce(F.arrays_overlap(hits, words).cast("int"), F.lit(0))


def add_theme_tags(
    df: DataFrame, keys: AndKeys, themes: Sequence[str], hits: str = HITS
) -> DataFrame:
    """Add `<theme>_tag` per keyword group and `keep_tag` = 1 where all themes are present."""
    tags = {f"{t}_tag": clip_to_one(theme_tag(keys.groups[t], hits)) for t in themes}
    tagged = computed_once(df, **tags)
    total = sum((F.col(f"{t}_tag") for t in themes), F.lit(0))
    return tagged.withColumn("keep_tag", F.when(total >= len(themes), 1).otherwise(0))


def widen_hits(df: DataFrame, words: Sequence[str], hits: str = HITS) -> DataFrame:
    """A 0/1 column per keyword of the dictionary, for exports."""
    return df.select("*", *[F.array_contains(hits, w).cast("int").alias(w) for w in words]).drop(hits)
