"""Keyword sheets, rule sheets and their driver-side form.

Sheets are hand-made and end up as literal patterns in the plan, so a sheet is the only kind
of table that is ever collected.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalweave.functions.text import split_on, strip_nbsp
from signalweave.sources.readers import Paths
from signalweave.sources.schemas import RULE_SHEET

MAX_ENTRIES = 20_000


@dataclass(frozen=True)
class Rule:
    """Text qualifies by `anchor` if it has a word of `include` (if any) and none of `exclude`."""

    anchor: str
    include: tuple[str, ...] = ()
    exclude: tuple[str, ...] = ()


@dataclass(frozen=True)
class AndKeys:
    """Keyword groups with `a+b` entries resolved."""

    groups: dict[str, list[str]]
    search_words: list[str]
    combined: dict[str, list[str]] = field(default_factory=dict)


def _collect_sheet(df: DataFrame) -> list:
    rows = df.limit(MAX_ENTRIES + 1).collect()
    if len(rows) > MAX_ENTRIES:
        raise ValueError(f"keyword sheet has more than {MAX_ENTRIES} entries; is it a data table?")
    return rows


def read_keyword_sheet(
    spark: SparkSession,
    path: Paths,
    sheet: str | None = None,
    lower: bool = False,
    strip: Callable[[Column], Column] = F.trim,
    clean_keys: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Wide sheet (a column per group) to long (sheet, group, pos, keyword) without blanks.

    `pos` is the row in the sheet.  `clean_keys` is an optional last step on the keyword.
    """
    wide = spark.read.options(header=True, multiLine=True, escape='"').csv(path)
    entries = F.array(
        *[F.struct(F.lit(c).alias("group"), F.col(f"`{c}`").alias("keyword")) for c in wide.columns]
    )
    rows = wide.withColumn("pos", F.monotonically_increasing_id()).select(
        "pos", F.explode(entries).alias("e")
    )
    keyword = strip(F.col("e.keyword"))
    if lower:
        keyword = F.lower(keyword)
    if clean_keys is not None:
        keyword = clean_keys(keyword)
    return rows.select(
        F.lit(sheet).alias("sheet"), F.col("e.group").alias("group"), "pos", keyword.alias("keyword")
    ).filter(F.col("keyword").isNotNull() & (F.trim("keyword") != ""))


def read_search_sheet(
    spark: SparkSession,
    path: Paths,
    sheet: str | None = None,
    lower: bool = True,
    clean_keys: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """As `read_keyword_sheet`, lowered and freed from no-break spaces."""
    return read_keyword_sheet(spark, path, sheet, lower, strip_nbsp, clean_keys)


def keyword_groups(sheet: DataFrame) -> dict[str, list[str]]:
    """Long sheet to {group: [keyword, ...]} in sheet order."""
    groups: dict[str, list[str]] = {}
    for row in sorted(_collect_sheet(sheet.select("group", "pos", "keyword")), key=lambda r: r.pos):
        groups.setdefault(row.group, []).append(row.keyword)
    return groups


def all_keywords(groups: dict[str, list[str]]) -> list[str]:
    """Distinct keywords of all groups, in order of first appearance."""
    return list(dict.fromkeys(k for words in groups.values() for k in words))


def and_keys(groups: dict[str, list[str]], mark: str = "+") -> AndKeys:
    """Resolve keywords such as `a+b`: their parts join the search words.

    The mark is a plain character; it is not a regular expression.
    """
    words = all_keywords(groups)
    combined = {
        w: [p.strip() for p in w.split(mark) if p.strip()] for w in words if mark in w
    }
    plain = [w for w in words if w not in combined]
    parts = [p for group in combined.values() for p in group]
    return AndKeys(groups, list(dict.fromkeys(plain + parts)), combined)


def read_rule_sheet(
    spark: SparkSession, path: Paths, policy: str | None = None, lower: bool = True
) -> DataFrame:
    """Rule sheet (anchor, include, exclude; `|`-separated) to arrays.

    Without `policy`, the policy is the file name up to its first dot, so that a folder of sheets
    becomes one rule table; a sheet named README is not a policy.
    """
    name = F.lit(policy) if policy else F.substring_index(F.col("_metadata.file_name"), ".", 1)
    raw = spark.read.schema(RULE_SHEET).options(header=True, multiLine=True, escape='"').csv(path)
    return rule_table(raw.withColumn("policy", name), lower).filter(F.col("policy") != "README")


def rule_table(raw: DataFrame, lower: bool = True) -> DataFrame:
    """(policy, anchor, include, exclude) strings to (policy, pos, anchor, arrays)."""

    def part(name: str) -> Column:
        c = F.coalesce(F.col(name), F.lit(""))
        return split_on(F.lower(c) if lower else c, "|")

    anchor = F.trim("anchor")
    return raw.select(
        "policy",
        F.monotonically_increasing_id().alias("pos"),
        (F.lower(anchor) if lower else anchor).alias("anchor"),
        part("include").alias("include"),
        part("exclude").alias("exclude"),
    ).filter(F.col("anchor").isNotNull() & (F.col("anchor") != ""))


def rulebook(rules: DataFrame, join_anchor: bool = False) -> dict[str, list[Rule]]:
    """Rule table to {policy: [Rule, ...]}.

    An anchor that occurs twice keeps its first place and its last definition.  With
    `join_anchor`, blanks in anchors become `_` (for searching phrase-joined text).
    """
    books: dict[str, dict[str, Rule]] = {}
    for row in sorted(_collect_sheet(rules), key=lambda r: r.pos):
        anchor = row.anchor.replace(" ", "_") if join_anchor else row.anchor
        books.setdefault(row.policy, {})[anchor] = Rule(anchor, tuple(row.include), tuple(row.exclude))
    return {policy: list(book.values()) for policy, book in books.items()}


def gazetteer_groups(gazetteer: DataFrame) -> dict[str, list[str]]:
    """(country, aliases) to {country: [alias, ...]}."""
    return {row.country: list(row.aliases) for row in _collect_sheet(gazetteer)}


def rules_of(entries: Iterable[tuple[str, Iterable[str], Iterable[str]]]) -> list[Rule]:
    """Rules from plain tuples."""
    return [Rule(a, tuple(i), tuple(e)) for a, i, e in entries]
