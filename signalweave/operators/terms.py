"""Expansion of query terms by context words, and tagging texts with the expanded terms."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalweave.functions.matching import contains_match, no_strings
from signalweave.functions.patterns import word_pattern


def expand_terms(
    terms: DataFrame, contexts: Sequence[str], context_free: Sequence[str] = ()
) -> DataFrame:
    """(category, term) to distinct (category, query): `term context` for each context word.

    Terms in `context_free` stay as they are.  The few context words are a literal array per
    row, so the expansion is an explode and needs neither a join nor a shuffle of the terms.
    """
    words = F.array(*map(F.lit, contexts))
    free = F.col("term").isin(list(context_free)) if context_free else F.lit(False)
    queries = F.when(free, F.array("term")).otherwise(
        F.transform(words, lambda w: F.concat_ws(" ", F.col("term"), w))
    )
    return terms.select("category", F.explode(queries).alias("query")).distinct()


def term_condition(
    text: str, term: str, contexts: Sequence[str], context_free: Iterable[str] = ()
) -> Column:
    """The term occurs, together with one of the context words unless it needs none."""
    found = contains_match(text, word_pattern([term], plural=False))
    if term in set(context_free):
        return found
    return found & contains_match(text, word_pattern(contexts, plural=False))


def tag_categories(
    df: DataFrame,
    categories: Mapping[str, Sequence[str]],
    contexts: Sequence[str],
    context_free: Iterable[str] = (),
    text: str = "text",
    column: str = "categories",
) -> DataFrame:
    """Add the ARRAY of categories for which a term-with-context query matches the text.

    All terms of a category share one pattern, and the context words one more, however many
    combinations they stand for.
    """
    free = set(context_free)
    with_context = contains_match(text, word_pattern(contexts, plural=False))
    labels = []
    for category, terms in categories.items():
        bound = contains_match(text, word_pattern([t for t in terms if t not in free], plural=False))
        alone = contains_match(text, word_pattern([t for t in terms if t in free], plural=False))
        labels.append(F.when(alone | (bound & with_context), F.lit(category)))
    tags = F.array_compact(F.array(*labels)) if labels else no_strings()
    return df.withColumn(column, tags)


def remap_keywords(df: DataFrame, column: str, mapping: DataFrame) -> DataFrame:
    """Add the `category` of a keyword from a long sheet (group, keyword); none where unknown.

    A keyword listed in several groups gives one row per group.
    """
    sheet = mapping.select(F.trim("keyword").alias("_key"), F.col("group").alias("category")).distinct()
    return df.join(sheet, F.trim(df[column]) == sheet["_key"], "left").drop("_key")
