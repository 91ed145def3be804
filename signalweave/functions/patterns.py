"""Regular expressions for whole-word keyword search.

A pattern is always a plain string that ends up as a literal in the plan: Spark compiles
a literal once per task, whereas a pattern taken from a column is compiled per row.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

# u + U make case folding and \b Unicode-aware, so "climático" meets "CLIMÁTICO".
ANY_CASE = "(?iuU)"
EXACT_CASE = "(?U)"
NEVER = r"(?!)"

PLURAL = ("s", "es")
INFLECTED = ("s", "es", "ly", "ing")


def escape(literal: str) -> str:
    """Take every symbol of `literal` literally."""
    return re.sub(r"([^\w\s])", r"\\\1", literal)


def _fold(letter: str) -> str:
    """The form in which case-insensitive matching compares letters."""
    if letter == "İ":
        return "i"
    upper = letter.upper() if len(letter.upper()) == 1 else letter
    return upper.lower() if len(upper.lower()) == 1 else upper


def alternation(words: Iterable[str], casing: bool = False) -> str:
    """Alternation that prefers earlier words, with common prefixes written once.

    Words are gathered by their first letter and the rest is treated alike.  Words that start
    differently cannot match at the same place, so gathering keeps the preferences; where a word
    ends inside others, those before it stay before it.  A dictionary of hundreds of words then
    costs a few comparisons per place instead of hundreds.
    """
    branches: list[str] = []
    gathered: dict[str, tuple[str, list[str]]] = {}

    def close() -> None:
        branches.extend(escape(letter) + alternation(rest, casing) for letter, rest in gathered.values())
        gathered.clear()

    for word in words:
        if word:
            key = word[0] if casing else _fold(word[0])
            gathered.setdefault(key, (word[0], []))[1].append(word[1:])
        elif "" not in branches:
            close()
            branches.append("")
    close()
    return branches[0] if len(branches) == 1 else f"(?:{'|'.join(branches)})"


def _usable(keywords: Iterable[str | None]) -> list[str]:
    return [k for k in keywords if k is not None and k.strip()]


def _suffix(suffixes: Sequence[str]) -> str:
    return f"(?:{'|'.join(suffixes)})?" if suffixes else ""


def word_pattern(
    keywords: Iterable[str | None],
    plural: bool = True,
    casing: bool = False,
    suffixes: Sequence[str] | None = None,
) -> str:
    """Whole-word alternation over `keywords`, earlier keywords winning.

    Word boundaries and suffix stand outside the alternation, so that a place inside a word is
    rejected by one test instead of one per keyword.  An empty list matches nothing.
    """
    words = _usable(keywords)
    if not words:
        return NEVER
    if suffixes is None:
        suffixes = PLURAL if plural else ()
    body = alternation(words, casing)
    flags = EXACT_CASE if casing else ANY_CASE
    return rf"{flags}\b{body}{_suffix(suffixes)}\b"


def inflected_pattern(keywords: Iterable[str | None]) -> str:
    """Whole words with an optional s / es / ly / ing ending."""
    return word_pattern([k.strip() for k in keywords if k], suffixes=INFLECTED)


def cooccurrence_pattern(keywords: Iterable[str | None]) -> str:
    """As `inflected_pattern`, where `"a,b"` means: a, then b later on the same line."""
    split = [[w.strip() for w in k.split(",") if w.strip()] for k in _usable(keywords)]
    body = "|".join(".*?".join(map(escape, words)) for words in split if words)
    if not body:
        return NEVER
    return rf"{ANY_CASE}\b(?:{body}){_suffix(INFLECTED)}\b"


def group_patterns(
    groups: Mapping[str, Iterable[str]],
    plural: bool = True,
    cased_groups: Iterable[str] = (),
) -> dict[str, str]:
    """One pattern per keyword group; groups in `cased_groups` respect letter case."""
    cased = set(cased_groups)
    return {
        name: word_pattern(words, plural=plural, casing=name in cased)
        for name, words in groups.items()
    }


def any_pattern(groups: Mapping[str, Iterable[str]], plural: bool = True) -> str:
    """One pattern that matches wherever any group would (used as a cheap first test)."""
    return word_pattern([w for words in groups.values() for w in words], plural=plural)
