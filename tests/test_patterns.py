"""Keyword patterns against Python's own regular expressions."""

from __future__ import annotations

import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from signalweave.functions.matching import (
    contains_match,
    count_all,
    find_all,
    frequency_map,
    gaps_between,
    group_tags,
    match_positions,
    unbroken,
)
from signalweave.functions.patterns import (
    NEVER,
    alternation,
    cooccurrence_pattern,
    escape,
    group_patterns,
    inflected_pattern,
    word_pattern,
)

words = st.lists(st.text(alphabet="abc +", min_size=1, max_size=5), min_size=1, max_size=8)


@settings(max_examples=300, deadline=None)
@given(words, st.text(alphabet="abcABC +", max_size=30))
def test_alternation_prefers_what_the_plain_list_prefers(keywords, text):
    plain = re.compile("(?:" + "|".join(re.escape(k) for k in keywords) + ")", re.I)
    shared = re.compile(alternation(keywords), re.I)
    assert [m.group() for m in shared.finditer(text)] == [m.group() for m in plain.finditer(text)]


@settings(max_examples=200, deadline=None)
@given(words, st.text(alphabet="abcABC +", max_size=30))
def test_alternation_with_suffix_and_boundaries(keywords, text):
    plain = re.compile("|".join(rf"\b{re.escape(k)}(?:b|c)?\b" for k in keywords))
    shared = re.compile(rf"\b{alternation(keywords, casing=True)}(?:b|c)?\b")
    assert [m.group() for m in shared.finditer(text)] == [m.group() for m in plain.finditer(text)]


def test_empty_list_matches_nothing(one):
    assert word_pattern([]) == word_pattern([None, " "]) == cooccurrence_pattern(["", ","]) == NEVER
    assert one("anything", find_all("text", NEVER)) == []


def test_escape_takes_symbols_literally():
    assert escape("a+b") == r"a\+b"


@pytest.mark.parametrize(
    ("keywords", "text", "expected"),
    [
        (["tax"], "tax taxes taxs taxi Tax", ["tax", "taxes", "taxs", "Tax"]),
        (["climático"], "CLIMÁTICO climático", ["CLIMÁTICO", "climático"]),
        (["en"], "en enè En", ["en", "En"]),
        (["carbon", "carbon tax"], "carbon tax", ["carbon"]),
        (["carbon tax", "carbon"], "carbon tax", ["carbon tax"]),
        (["R&D"], "our R&D, R D", ["R&D"]),
        (["c++"], "c++ and c++", []),
        (["carbontax"], "carbon\ntax", ["carbontax"]),
        (["carbon"], None, []),
    ],
)
def test_find_all(one, keywords, text, expected):
    assert one(text, find_all("text", word_pattern(keywords))) == expected


def test_symbol_next_to_boundary(one):
    """A boundary next to a symbol needs a word character on its other side."""
    assert one("c++ x", find_all("text", word_pattern(["c++"], plural=False))) == []
    assert one("c++x", find_all("text", word_pattern(["c++"], plural=False))) == ["c++"]


def test_letter_case_and_plural_switches(one):
    assert one("US us", find_all("text", word_pattern(["US"], casing=True))) == ["US"]
    assert one("taxes tax", find_all("text", word_pattern(["tax"], plural=False))) == ["tax"]


def test_inflections_and_cooccurrence(one):
    assert one("warm warming warmly warmth", find_all("text", inflected_pattern(["warm"]))) == [
        "warm", "warming", "warmly",
    ]
    text = "money should be spent; spending on money"
    assert one(text, contains_match("text", cooccurrence_pattern(["money,spent"]))) is True
    assert one("spent the money", contains_match("text", cooccurrence_pattern(["money,spent"]))) is False


def test_counts_and_frequency(one):
    text = "tax and Tax and taxes"
    found, total = one(text, frequency_map(find_all("text", word_pattern(["tax"]))), count_all("text", word_pattern(["tax"])))
    assert found == {"tax": 1, "Tax": 1, "taxes": 1} and total == 3
    assert one(None, count_all("text", word_pattern(["tax"]))) == 0


@settings(max_examples=25, deadline=None)
@given(st.text(alphabet="ab é.", max_size=40))
def test_positions_equal_finditer(spark, text):
    pattern = word_pattern(["ab", "a", "é"])
    positions = match_positions(find_all("text", pattern, clean=False), gaps_between("text", pattern))
    row = spark.createDataFrame([(text,)], "text STRING").select(positions.alias("p")).first()
    expected = [(m.group(), m.start()) for m in re.finditer(r"\b(?:ab|a|é)(?:s|es)?\b", text, re.I)]
    assert [(h["match"], h["start"]) for h in row.p] == expected


def test_unbroken(one):
    assert one("a\r\nb\nc", unbroken("text")) == "abc"
    assert one("a\r\nb\nc", unbroken("text", " ")) == "a b c"


def test_group_tags(one):
    groups = {"china": ["china", "chinese"], "united states of america": ["US"], "iran": ["iran"]}
    cased = ["united states of america"]
    assert one("Chinese goods in the US", group_tags("text", groups, cased)) == ["china", "united states of america"]
    assert one("give us iran", group_tags("text", groups, cased)) == ["iran"]
    assert one(None, group_tags("text", groups, cased)) == []
    assert one("x", group_tags("text", {})) == []
    assert set(group_patterns(groups)) == set(groups)


def test_many_groups(one):
    groups = {f"g{i}": [f"word{i}"] for i in range(250)}
    assert one("word3 word249", group_tags("text", groups)) == ["g3", "g249"]
