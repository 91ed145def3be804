"""Group tags, keyword counts and dummies on text columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalweave.functions.matching import (
    count_all,
    find_all,
    frequency_map,
    gaps_between,
    group_tags,
    match_positions,
    unbroken,
)
from signalweave.functions.patterns import group_patterns, word_pattern
from signalweave.operators.enrich import dummy, row_sum
from signalweave.operators.once import computed_once, explode_once

# Gazetteer entries whose aliases respect letter case.
CASED_COUNTRIES = ("united-states", "united states of america")


def tag_countries(
    posts: DataFrame,
    gazetteer: Mapping[str, Iterable[str]],
    text: str = "text_processed",
    column: str = "Country",
    cased: Iterable[str] = CASED_COUNTRIES,
) -> DataFrame:
    """Add the ARRAY of all countries named in the text (aliases also match in the plural)."""
    return posts.withColumn(column, group_tags(text, gazetteer, cased_groups=cased))


def explode_tags(df: DataFrame, tags: str, column: str) -> DataFrame:
    """One row per tag; rows without tags go away."""
    return explode_once(df, column, F.col(tags)).drop(tags)


def group_counts(
    df: DataFrame, groups: Mapping[str, Iterable[str]], text: str = "text", plural: bool = False
) -> DataFrame:
    """Add `<group>_count` and `<group>_dummy` for every keyword group."""
    patterns = group_patterns(groups, plural=plural)
    counted = computed_once(df, **{f"{g}_count": count_all(text, p) for g, p in patterns.items()})
    return counted.select("*", *[dummy(f"{g}_count").alias(f"{g}_dummy") for g in patterns])


def add_multi_group(df: DataFrame, groups: Sequence[str], column: str = "all_dummy") -> DataFrame:
    """1 where at least two groups are present."""
    return df.withColumn(column, dummy(row_sum([f"{g}_dummy" for g in groups]) - 1))


def keyword_frequency(df: DataFrame, keywords: Iterable[str], text: str = "text") -> DataFrame:
    """Corpus totals per surface form: (keyword, n)."""
    found = explode_once(df.select(text), "keyword", find_all(text, word_pattern(keywords)))
    return found.groupBy("keyword").agg(F.count(F.lit(1)).alias("n"))


def add_match_map(
    df: DataFrame, keywords: Iterable[str], text: str = "text", column: str = "matches"
) -> DataFrame:
    """Add MAP<surface form, occurrences>; the text is searched once."""
    found = computed_once(df, _found=find_all(text, word_pattern(keywords)))
    return found.withColumn(column, frequency_map("_found")).drop("_found")


def explode_positions(
    df: DataFrame, pattern: str, keep: Sequence[str], text: str = "text"
) -> DataFrame:
    """One row per match with its 0-based offset in the unbroken text."""
    lines = df.select(*keep, unbroken(text).alias("_line"))
    searched = computed_once(lines, _found=find_all("_line", pattern, clean=False))
    pieces = gaps_between("_line", pattern)
    cut = computed_once(searched.filter(F.size("_found") > 0), _pieces=pieces)
    hits = explode_once(cut.select(*keep, "_found", "_pieces"), "_hit", match_positions("_found", "_pieces"))
    return hits.select(*keep, "_hit.match", "_hit.start")
