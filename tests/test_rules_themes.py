"""Rules, AND keys, themes, term expansion and tags on small tables."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from signalweave.operators.rules import add_policies, add_policy_columns, explain_policy
from signalweave.operators.tagging import (
    add_match_map, add_multi_group, explode_positions, explode_tags, group_counts, keyword_frequency, tag_countries,
)
from signalweave.operators.terms import expand_terms, remap_keywords, tag_categories, term_condition
from signalweave.operators.themes import add_hits, add_theme_tags, widen_hits
from signalweave.functions.patterns import word_pattern
from signalweave.plans.user_posts import theme_posts
from signalweave.sources.dictionaries import and_keys, rules_of
from signalweave.sources.term_lists import (
    CONTEXT_FREE, CONTEXTS, FURTHER_MARKET_TERMS, MARKET_TERMS, NONMARKET_TERMS,
)

RULES = rules_of(
    [
        ("carbon tax", [], []),
        ("subsidy", ["energy", "fuel"], []),
        ("levy", [], ["import"]),
        ("quota", ["emission"], ["milk"]),
    ]
)

CASES = [
    ("A Carbon Tax is due", True, ["carbon tax"], None),
    ("subsidy for energy, energy and fuel", True, ["subsidy"], ["energy", "fuel"]),
    ("subsidy for farms", False, ["subsidy"], None),
    ("a levy", True, ["levy"], None),
    ("an import levy", False, ["levy"], None),
    ("emission quota", True, ["quota"], ["emission"]),
    ("milk emission quota", False, ["quota"], None),
    ("subsidy and levy", True, ["levy"], None),
    ("carbon\ntax", False, [], None),
    ("nothing", False, [], None),
    (None, False, [], None),
]


@pytest.fixture(scope="module")
def judged(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i INT, text STRING")
    return df


def test_explain_policy(judged):
    rows = {r.i: r for r in explain_policy(judged, RULES).collect()}
    for i, (_, status, anchors, include) in enumerate(CASES):
        assert (rows[i].status, rows[i].anchor_check, rows[i].include_check) == (status, anchors, include), i
        assert rows[i].exclude_check is None


def test_policy_tags_agree_with_the_explanation(judged):
    book = {"p": RULES, "q": rules_of([("levy", ["import"], [])])}
    rows = add_policy_columns(add_policies(judged, book), list(book)).collect()
    assert {r.i for r in rows if "p" in r.policies} == {i for i, c in enumerate(CASES) if c[1]}
    assert {r.i for r in rows if r.q} == {4}
    assert all(r.p == ("p" in r.policies) for r in rows)


def test_strict_surface_needs_the_dictionary_spelling(judged):
    loose = add_policies(judged, {"p": RULES}).filter(F.size("policies") > 0)
    strict = add_policies(judged, {"p": RULES}, strict_surface=True).filter(F.size("policies") > 0)
    assert 0 in {r.i for r in loose.collect()} and 0 not in {r.i for r in strict.collect()}


def test_short_anchor_hides_a_longer_one(spark):
    df = spark.createDataFrame([("carbon tax",)], "text STRING")
    rules = rules_of([("carbon", ["never"], []), ("carbon tax", [], [])])
    assert explain_policy(df, rules).first().status is False
    assert explain_policy(df, rules[::-1]).first().status is True


def test_and_keys_are_split_at_a_plain_plus():
    keys = and_keys({"Climate_Keys": ["clima", "normas+mercado"], "Policy_Keys": ["ley", "clima"]})
    assert keys.search_words == ["clima", "ley", "normas", "mercado"]
    assert keys.combined == {"normas+mercado": ["normas", "mercado"]}


def test_theme_filter(spark):
    keys = and_keys({"Climate_Keys": ["clima", "normas+mercado"], "Policy_Keys": ["ley"]})
    texts = ["CLIMA y ley", "clima solo", "normas del mercado, ley", "normas y ley", "ley", "clima", None, "ley x"]
    df = spark.createDataFrame(list(enumerate(texts)), "i INT, text STRING")
    tagged = {r.i: r for r in add_theme_tags(add_hits(df, keys), keys, ["Climate_Keys", "Policy_Keys"]).collect()}
    assert [tagged[i].keep_tag for i in range(8)] == [1, 0, 1, 0, 0, 0, 0, 0]
    assert tagged[2].hits[-1] == "normas+mercado" and tagged[3].Climate_Keys_tag == 0
    assert {r.i for r in theme_posts(df, keys).collect()} == {0, 2}
    wide = widen_hits(add_hits(df, keys), ["clima", "normas+mercado"]).filter("i = 2").first()
    assert (wide["clima"], wide["normas+mercado"]) == (0, 1)


def test_length_filter_keeps_six_characters(spark):
    keys = and_keys({"Climate_Keys": ["a"], "Policy_Keys": ["b"]})
    df = spark.createDataFrame([("a b  ",), ("a b   ",)], "text STRING")
    assert [len(r.text) for r in theme_posts(df, keys).collect()] == [6]


def test_tags_and_counts(spark):
    df = spark.createDataFrame([(1, "Chinese tax on iran"), (2, "no"), (3, None)], "id INT, text STRING")
    tagged = tag_countries(df, {"china": ["china", "chinese"], "iran": ["iran"]}, "text")
    assert [(r.id, r.c) for r in explode_tags(tagged, "Country", "c").collect()] == [(1, "china"), (1, "iran")]
    counted = add_multi_group(group_counts(df, {"a": ["tax"], "b": ["iran", "on"]}), ["a", "b"])
    rows = [(r.a_count, r.a_dummy, r.b_count, r.b_dummy, r.all_dummy) for r in counted.orderBy("id").collect()]
    assert rows == [(1, 1, 2, 1, 1), (0, 0, 0, 0, 0), (0, 0, 0, 0, 0)]
    assert {(r.keyword, r.n) for r in keyword_frequency(df, ["tax", "no"]).collect()} == {("tax", 1), ("no", 1)}
    assert add_match_map(df, ["tax"]).filter("id = 1").first().matches == {"tax": 1}


def test_positions_on_rows(spark):
    text = "tax, taxes\nand Tax"
    df = spark.createDataFrame([(1, text), (2, "none"), (3, None)], "id INT, text STRING")
    hits = explode_positions(df, word_pattern(["tax"]), ["id"]).collect()
    line = text.replace("\n", "")
    expected = [(1, m.group(), m.start()) for m in re.finditer(r"\btax(?:s|es)?\b", line, re.I)]
    assert sorted((h.id, h.match, h.start) for h in hits) == sorted(expected)


def test_term_expansion_of_the_fixed_lists(spark):
    rows = [("market", t) for t in MARKET_TERMS + FURTHER_MARKET_TERMS] + [("nonmarket", t) for t in NONMARKET_TERMS]
    terms = spark.createDataFrame(rows, "category STRING, term STRING")
    queries = expand_terms(terms, CONTEXTS, CONTEXT_FREE + FURTHER_MARKET_TERMS)
    assert {r.category: r["count"] for r in queries.groupBy("category").count().collect()} == {"market": 292, "nonmarket": 374}


def test_category_tags(spark):
    df = spark.createDataFrame([("tariffs on carbon",), ("tariffs",), ("green certificates",), ("R&D energy tariffs",)], "text STRING")
    tagged = tag_categories(df, {"market": MARKET_TERMS, "nonmarket": NONMARKET_TERMS}, CONTEXTS, CONTEXT_FREE)
    assert [r.categories for r in tagged.collect()] == [["market"], [], ["market"], ["market", "nonmarket"]]
    one = df.select(term_condition("text", "tariffs", CONTEXTS).alias("c")).collect()
    assert [r.c for r in one] == [True, False, False, True]


def test_remap(spark):
    sheet = spark.createDataFrame([("market", "tariffs climate "), ("nonmarket", "codes climate")], "group STRING, keyword STRING")
    df = spark.createDataFrame([("tariffs climate",), ("other",)], "k STRING")
    assert [(r.k, r.category) for r in remap_keywords(df, "k", sheet).orderBy("k").collect()] == [("other", None), ("tariffs climate", "market")]
