"""Keyword matching: existence, counts, frequency maps, positions and multi-label tags."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from signalweave.functions.patterns import any_pattern, group_patterns

NO_STRINGS = "array<string>"
SLICE = 100


def as_column(text: Column | str) -> Column:
    return F.col(text) if isinstance(text, str) else text


def no_strings() -> Column:
    return F.array().cast(NO_STRINGS)


def unbroken(text: Column | str, newline: str = "") -> Column:
    """Text on one line.  By default line breaks vanish, which joins the words around them."""
    column = as_column(text)
    if not newline:
        # Two literal replacements take less than half the time of one `translate`.
        return F.replace(F.replace(column, F.lit("\r"), F.lit("")), F.lit("\n"), F.lit(""))
    return F.regexp_replace(column, r"\r\n|\r|\n", newline)


def contains_match(text: Column | str, pattern: str) -> Column:
    """Whether the pattern occurs; NULL text does not match."""
    return F.coalesce(as_column(text).rlike(pattern), F.lit(False))


def find_all(text: Column | str, pattern: str, clean: bool = True, newline: str = "") -> Column:
    """All non-overlapping matches from left to right; empty for NULL text.

    `clean` searches the unbroken text, with `newline` in place of line breaks.
    """
    column = unbroken(text, newline) if clean else as_column(text)
    return F.coalesce(F.regexp_extract_all(column, F.lit(pattern), F.lit(0)), no_strings())


def count_all(text: Column | str, pattern: str, clean: bool = True, newline: str = "") -> Column:
    """Number of matches; 0 for NULL text."""
    column = unbroken(text, newline) if clean else as_column(text)
    return F.coalesce(F.regexp_count(column, F.lit(pattern)), F.lit(0))


def frequency_map(matches: Column | str) -> Column:
    """Array of surface forms to MAP<form, occurrences>, in order of first appearance."""
    found = as_column(matches)
    return F.map_from_entries(
        F.transform(
            F.array_distinct(found),
            lambda form: F.struct(form, F.size(F.filter(found, lambda m: m == form))),
        )
    )


def running_sum(numbers: Column) -> Column:
    """Inclusive prefix sums of an integer array."""
    return F.aggregate(
        numbers,
        F.array().cast("array<int>"),
        lambda done, n: F.concat(
            done, F.array(F.coalesce(F.try_element_at(done, F.lit(-1)), F.lit(0)) + n)
        ),
    )


def gaps_between(text: Column | str, pattern: str) -> Column:
    """The pieces of text before, between and after the matches."""
    return F.split(as_column(text), pattern, -1)


def match_positions(matches: Column | str, pieces: Column | str) -> Column:
    """ARRAY<STRUCT<match, start>> with 0-based offsets, from `find_all` and `gaps_between`.

    Spark offers no call that returns all offsets.  Splitting the text at the matches gives
    the gaps, and an offset is the sum of the earlier gaps and matches.
    """
    matches, pieces = as_column(matches), as_column(pieces)
    spans = F.zip_with(matches, pieces, lambda m, p: F.length(p) + F.coalesce(F.length(m), F.lit(0)))
    ends = running_sum(F.slice(spans, 1, F.size(matches)))
    return F.zip_with(
        matches, ends, lambda m, end: F.struct(m.alias("match"), (end - F.length(m)).alias("start"))
    )


def group_tags(
    text: Column | str,
    groups: Mapping[str, Iterable[str]],
    cased_groups: Iterable[str] = (),
    plural: bool = True,
) -> Column:
    """ARRAY of the names of all groups with a keyword in the text, in dictionary order.

    A first test with all keywords at once skips the per-group tests for the many texts that
    match nothing.  Labels are gathered in slices to keep generated methods small.
    """
    column = as_column(text)
    patterns = group_patterns(groups, plural=plural, cased_groups=cased_groups)
    labels = [F.when(column.rlike(p), F.lit(name)) for name, p in patterns.items()]
    if not labels:
        return no_strings()
    slices = [F.array(*labels[i : i + SLICE]) for i in range(0, len(labels), SLICE)]
    found = F.array_compact(slices[0] if len(slices) == 1 else F.concat(*slices))
    if len(labels) > 1:
        found = F.when(column.rlike(any_pattern(groups, plural=plural)), found)
    return F.coalesce(found, no_strings())
