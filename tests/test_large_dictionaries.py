"""Dictionaries and stored queries as tables against the literal patterns."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from signalweave.functions.matching import group_tags
from signalweave.functions.predicates import term
from signalweave.operators.large_dictionaries import folded, percolate, tag_by_dictionary

GROUPS = {
    "tax": ["carbon tax", "levy", "tax on tax"],
    "signs": ["c++", "(x)", "R&D", "+++", "a-b c"],
    "places": ["cote d'ivoire", "İzmir", "straße", "CLIMÁTICO", "Ωμέγας"],
    "us": ["US", "It"],
    "one": ["the", "   ", "under_score", "42"],
}
TEXTS = [
    "a carbon tax is a levy", "Carbon  tax", "carbon\ntax", "CARBON TAXES and levies", "carbon taxi", "a tax on taxes on tax",
    "tax on tax", "c++", "c++s done", "ac++b", "x c++b", "f(x)", "f(x)s", "(x)y", "a (x)es", "r&d", "R&Ds", "R & D", "a+++b", "+++", "x+++s",
    "a-b c", "a-b cs", "A-B  C", "Cote d'Ivoires", "cote divoire", "izmir", "IZMIR", "ızmir", "İZMİR", "STRAẞE straße", "strasse",
    "climático", "climáticos!", "ωμέγας", "ΩΜΈΓΑΣ", "ωμέγαςs", "US", "us", "It it", "its", "Its", "their", "the", "THEs", "under_score under_scores",
    "42 423", "42s", "", None, "the the the levy's", "levy levy",
]


@pytest.fixture(scope="module")
def posts(spark):
    rows = [(None if i % 7 == 0 else i % 20, t, "x") for i, t in enumerate(TEXTS * 2)]
    return spark.createDataFrame(rows, "id INT, text STRING, name STRING").selectExpr("*", "'y' AS gram", "'z' AS alias")


@pytest.mark.parametrize("plural", [True, False])
def test_dictionary_table_equals_literal_patterns(spark, posts, plural):
    rows = [(g, a, g == "us") for g, words in GROUPS.items() for a in words + words[:1]] + [("none", None, None)]
    dictionary = spark.createDataFrame(rows, "name STRING, alias STRING, cased BOOLEAN")
    tagged = tag_by_dictionary(posts, dictionary, plural=plural)
    assert tagged.columns == [*posts.columns, "tags"]
    wanted = posts.withColumn("tags", F.array_sort(group_tags("text", GROUPS, ("us",), plural)))
    assert tagged.exceptAll(wanted).collect() == [] and tagged.count() == posts.count()


def test_dictionary_of_many_entries_under_one_word(spark):
    """More entries than a sheet may have; all share a word, which is no key of theirs."""
    entries = spark.range(30_000).select(F.concat(F.lit("n"), F.col("id")).alias("name"), F.concat(F.lit("red widget "), F.col("id")).alias("alias"))
    texts = spark.range(200).select("id", F.concat(F.lit("a red widget "), F.col("id") * 997, F.lit(" here")).alias("text"))
    tagged = tag_by_dictionary(texts, entries).select("id", "tags").collect()
    assert {r["id"]: r["tags"] for r in tagged} == {i: [f"n{i * 997}"] if i * 997 < 30_000 else [] for i in range(200)}


def test_empty_tables(spark, posts):
    nothing = spark.createDataFrame([], "name STRING, alias STRING")
    assert {len(r["tags"]) for r in tag_by_dictionary(posts, nothing).collect()} == {0}
    some = spark.createDataFrame([("a", "tax")], "name STRING, alias STRING")
    assert tag_by_dictionary(posts.limit(0), some).collect() == []
    queries = spark.createDataFrame([], "query_id INT, clauses ARRAY<ARRAY<STRING>>, excluded ARRAY<STRING>")
    assert percolate(posts, queries, "id").collect() == []


QUERIES = [
    (1, [["carbon tax", "levy"]], []), (2, [["the"], ["levy", "US"]], None), (3, [["tax"], ["carbon"]], ["levy"]),
    (4, [], ["tax"]), (5, [["never seen"], ["tax"]], []), (6, [["r&d", None]], []), (7, [[]], []), (8, [["42", "42s", "42"]], [None]),
    (8, [["42", "42s", "42"]], [None]),
]


def test_stored_queries_equal_conditions(spark):
    texts = [(i, t) for i, t in enumerate(TEXTS)]
    posts = spark.createDataFrame(texts, "id INT, text STRING")
    queries = spark.createDataFrame(QUERIES, "query_id INT, clauses ARRAY<ARRAY<STRING>>, excluded ARRAY<STRING>")
    got = sorted(tuple(r) for r in percolate(posts, queries, "id").collect())
    wanted = set()
    for number, clauses, excluded in QUERIES:
        if not clauses:
            continue
        test = F.lit(True)
        for clause in clauses:
            any_ = F.lit(False)
            for word in filter(None, clause):
                any_ = any_ | term("text", word)
            test = test & any_
        for word in filter(None, excluded or []):
            test = test & ~term("text", word)
        wanted |= {(r["id"], number) for r in posts.filter(test).collect()}
    assert got == sorted(wanted)


def test_keys_of_a_small_dictionary_go_to_the_texts(spark):
    """The grams of all texts neither travel nor are sorted before they meet the keys; plain aliases need no pattern."""
    texts = spark.createDataFrame([(1, "a carbon tax"), (2, "levies")], "id INT, text STRING")
    entries = spark.createDataFrame([("a", "carbon tax"), ("b", "levy"), ("c", "c++")], "name STRING, alias STRING")
    plan = tag_by_dictionary(texts, entries)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin [gram" in plan and "SortMergeJoin [gram" not in plan


def test_words_of_a_to_z_are_equal_in_folded_form_only_where_a_search_finds_them(spark):
    letter = F.expr("decode(unhex(lpad(hex(id), 4, '0')), 'UTF-16BE')")
    letters = spark.range(1, 0x10000).filter("id < 55296 OR id > 57343").select(letter.alias("c"))
    forms = letters.select("c", folded(F.col("c")).alias("form")).filter(F.col("form").rlike(r"\A[a-z0-9_]+\z"))
    assert forms.filter("c = 'ſ' OR c = 'İ'").count() == 2
    assert forms.filter(~F.rlike("c", F.concat(F.lit(r"(?iuU)\A"), "form", F.lit(r"\z")))).collect() == []
    rows = spark.createDataFrame([(1, "straße ﬁne STRAẞE oﬀ"), (2, "ſtrasse FINE"), (3, "fine,strasse off  tax"), (4, "off tax,off\ntaxes")], "id INT, text STRING")
    entries = spark.createDataFrame([(a, a) for a in ("strasse", "fine", "off", "off tax", "fine strasse")], "name STRING, alias STRING")
    got = {r["id"]: r["tags"] for r in tag_by_dictionary(rows, entries).collect()}
    assert got == {1: [], 2: ["fine", "strasse"], 3: ["fine", "off", "strasse"], 4: ["off", "off tax"]}
