"""Anchor / include / exclude rules.

A text satisfies a policy if one of its anchors occurs, and for that anchor a word of `include`
occurs (when there are any) and none of `exclude` does.  Anchors found are those of one search
from left to right: an anchor inside an earlier match is not found.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalweave.functions.matching import NO_STRINGS, as_column, find_all, no_strings, unbroken
from signalweave.functions.patterns import word_pattern
from signalweave.operators.once import computed_once
from signalweave.sources.dictionaries import Rule

LINE = "_line"


def anchor_pattern(rules: Iterable[Rule]) -> str:
    return word_pattern([r.anchor for r in rules], plural=False)


def _whole(words: Sequence[str]) -> str:
    return word_pattern(words, plural=False)


def rule_condition(rule: Rule, anchors: Column | str, line: Column | str = LINE) -> Column:
    """Whether the anchor was found and the words around it permit the rule.

    The words are searched only where the anchor was found.
    """
    line = as_column(line)
    condition = F.array_contains(as_column(anchors), rule.anchor)
    if rule.include:
        condition = condition & line.rlike(_whole(rule.include))
    if rule.exclude:
        condition = condition & ~line.rlike(_whole(rule.exclude))
    return condition


def permitted_anchors(rules: Sequence[Rule], anchors: Column | str, line: Column | str = LINE) -> Column:
    """Anchors found whose rule is satisfied, in dictionary order."""
    satisfied = [F.when(rule_condition(r, anchors, line), F.lit(r.anchor)) for r in rules]
    return F.array_compact(F.array(*satisfied)).cast(NO_STRINGS)


def rule_line(text: Column | str, strict_surface: bool = False) -> Column:
    """The searched form of a text: line breaks removed and, unless strict, lower-cased.

    With `strict_surface` an anchor counts only where the text spells it as the dictionary does.
    """
    line = F.coalesce(unbroken(text), F.lit(""))
    return line if strict_surface else F.lower(line)


def explain_policy(
    df: DataFrame, rules: Sequence[Rule], text: str = "text", strict_surface: bool = False
) -> DataFrame:
    """Add `status`, `anchor_check`, `include_check` and `exclude_check`.

    `anchor_check` is the first anchor, in text order, that satisfied its rule; if none did, all
    anchors found.  `include_check` lists the include words found for that anchor.
    """
    known = F.array(*[F.lit(r.anchor) for r in rules]).cast(NO_STRINGS)
    found = F.filter(F.array_distinct(find_all(LINE, anchor_pattern(rules), clean=False)),
                     lambda a: F.array_contains(known, a))
    lines = df.withColumn(LINE, rule_line(text, strict_surface))
    hits = F.when(F.size("_anchors") > 0, F.array_intersect("_anchors", permitted_anchors(rules, "_anchors")))
    decided = computed_once(
        computed_once(lines, _anchors=found), _first=F.try_element_at(hits, F.lit(1))
    )
    evidence = F.lit(None).cast(NO_STRINGS)
    for rule in rules:
        if rule.include:
            words = F.array_distinct(find_all(LINE, _whole(rule.include), clean=False))
            evidence = F.when(F.col("_first") == rule.anchor, words).otherwise(evidence)
    return decided.select(
        *df.columns,
        F.col("_first").isNotNull().alias("status"),
        F.when(F.col("_first").isNotNull(), F.array("_first")).otherwise(F.col("_anchors")).alias(
            "anchor_check"
        ),
        evidence.alias("include_check"),
        F.lit(None).cast(NO_STRINGS).alias("exclude_check"),
    )


def add_policies(
    df: DataFrame,
    book: Mapping[str, Sequence[Rule]],
    text: str = "text",
    column: str = "policies",
    strict_surface: bool = False,
) -> DataFrame:
    """Add the ARRAY of all satisfied policies.

    Texts without any anchor stop after one test; the others are searched once per policy for
    anchors, and per anchor found for its include and exclude words.
    """
    if not book:
        return df.withColumn(column, no_strings())
    names = {policy: f"_anchors{place}" for place, policy in enumerate(book)}
    anywhere = F.col(LINE).rlike(anchor_pattern([r for rules in book.values() for r in rules]))
    found = {
        names[policy]: F.when(anywhere, find_all(LINE, anchor_pattern(rules), clean=False))
        for policy, rules in book.items()
    }
    searched = computed_once(df.withColumn(LINE, rule_line(text, strict_surface)), **found)
    labels = [
        F.when(F.size(permitted_anchors(rules, names[policy])) > 0, F.lit(policy))
        for policy, rules in book.items()
    ]
    tags = F.when(F.col(names[next(iter(book))]).isNotNull(), F.array_compact(F.array(*labels)))
    tagged = computed_once(searched, **{column: F.coalesce(tags, no_strings())})
    return tagged.drop(LINE, *names.values())


def add_policy_columns(df: DataFrame, policies: Sequence[str], tags: str = "policies") -> DataFrame:
    """A BOOLEAN column per policy, for wide exports."""
    return df.select("*", *[F.array_contains(tags, p).alias(p) for p in policies])
