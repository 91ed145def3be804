"""Keyword in context, language, metadata and paragraphs."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F
from signalweave.operators.documents import (
    assemble_paragraphs, document_facts, enrich_metadata, inflections, keyword_windows, plain_text, strip_lookup,
    structured_paragraphs,
)
from signalweave.plans.document_search import search_documents
from signalweave.sources.dictionaries import rules_of


def brute_windows(tokens, forms, window):
    half = window // 2
    return [
        (i, t, " ".join(tokens[max(i - half, 0) : min(i + half, len(tokens))]))
        for i, t in enumerate(tokens) if t in forms
    ]


def test_windows_equal_brute_force(spark):
    rules = rules_of([("tax", [], []), ("levy", [], [])])
    sentences = ["a b tax c d e f g h i j.", "k l m n o p q taxes r", "levy"]
    text = " ".join(sentences)
    docs = spark.createDataFrame([(1, text), (2, "nothing here"), (3, None)], "doc_id INT, text STRING")
    got = {(r.token_pos, r.surface, r.window) for r in keyword_windows(docs, rules, window=10, negation_window=4).collect()}
    tokens = [t for t in re.sub(r"\.(\s|$)", " . ", text).split()]
    expected = set(brute_windows(tokens, inflections(["tax", "levy"]), 10))
    assert got == expected and len(got) == 3
    by_pos = {r.token_pos: r for r in keyword_windows(docs, rules, window=10, negation_window=4).collect()}
    assert by_pos[2].window == "a b tax c d e f" and by_pos[2].neg_window == "a b tax c"
    assert by_pos[2].sentence == "a b tax c d e f g h i j ."
    last = max(by_pos)
    assert by_pos[last].surface == "levy" and by_pos[last].window.endswith("levy")


def test_default_window_is_15_before_and_14_after(spark):
    tokens = [f"w{i}" for i in range(40)]
    tokens[20] = "tax"
    docs = spark.createDataFrame([(1, " ".join(tokens))], "doc_id INT, text STRING")
    row = keyword_windows(docs, rules_of([("tax", [], [])])).first()
    window = row.window.split()
    assert window.index("tax") == 15 and len(window) == 30
    assert row.neg_window.split().index("tax") == 5 and len(row.neg_window.split()) == 10


@pytest.mark.parametrize(
    ("include", "exclude", "flags"),
    [
        ([], [], (1, 1, 0)),
        (["money"], [], (1, 1, 0)),
        (["later"], [], (0, 1, 0)),
        (["money,should"], ["tighten"], (0, 0, 1)),
        (["should,money"], ["later"], (1, 1, 0)),
        (["absent"], ["absent"], (0, 0, 0)),
    ],
)
def test_context_flags(spark, include, exclude, flags):
    docs = spark.createDataFrame([(1, ["The fiscal multiplier should tighten money.", "And later more."])], "doc_id INT, paras ARRAY<STRING>")
    rules = rules_of([("fiscal_multiplier", include, exclude)])
    (row,) = search_documents(docs, rules).collect()
    assert row.search_key == "fiscal_multiplier"
    assert (row.sentence_match, row.range_match, row.exclude) == flags


def test_inflections_prefer_the_longest_key():
    forms = inflections(["tax", "taxe", "warm"])
    assert forms["taxes"] == "taxe" and forms["taxs"] == "tax" and forms["warming"] == "warm" and forms["warmly"] == "warm"


def test_strip_lookup(spark):
    keys = spark.createDataFrame([("tax",), ("taxe",), ("levy",)], "k STRING")
    df = spark.createDataFrame([("tax",), ("taxes",), ("levying",), ("levyable",), ("xyz",), (None,)], "w STRING")
    rows = {r.w: r.matched_key for r in strip_lookup(df, "w", keys, "k").collect()}
    assert rows == {"tax": "tax", "taxes": "taxe", "levying": "levy", "levyable": None, "xyz": None, None: None}


def test_language_and_metadata(spark):
    docs = spark.createDataFrame(
        [("a", "the cat and the dog was with it"), ("b", "der hund und die katze ist nicht"), ("c", "zzz"), ("d", None)],
        "doc_id STRING, text STRING",
    )
    facts = {r.doc_id: (r.lang, r.word_count) for r in document_facts(docs).collect()}
    assert facts == {"a": ("en", 8), "b": ("de", 7), "c": ("NA", 1), "d": ("NA", 0)}
    meta = spark.createDataFrame([("a", "A Request"), ("COR.x", None)], "doc_id STRING, title STRING")
    rows = {r.doc_id: (r.cor, r.request, r.lang, r.word_count) for r in enrich_metadata(meta, document_facts(docs)).collect()}
    assert rows == {"a": (False, True, "en", 8), "COR.x": (True, False, None, None)}


def test_paragraphs_of_structured_documents(spark):
    xml = (
        "<article><front><p/></front><body><p>One\n<b>two</b> &amp; &lt;3</p><fig><p>gone</p></fig>"
        "<table-wrap id='t'><p>gone</p></table-wrap>"
        "<list><list-item>a</list-item> <list-item>b</list-item></list><!-- <p>no</p> --><p>last</p></body></article>"
    )
    df = spark.createDataFrame([(xml,), ("<body>none</body>",), (None,)], "x STRING")
    rows = [r.p for r in df.select(structured_paragraphs("x").alias("p")).collect()]
    assert rows[0][-3:] == ["One two & <3", "a b", "last"] and rows[1:] == [[], []]


def test_character_references(one):
    text = "&#233;t&#xE9; &#128512;&amp;#65; &#0; &#55296; &#x110000; &#; &#99999999; &lt;"
    assert one(text, plain_text(F.col("text"))) == "été 😀&#65; &#0; &#55296; &#x110000; &#; &#99999999; <"
    assert one("a\nb", plain_text(F.col("text"))) == "a b"


def test_lines_come_back_in_order(spark):
    lines = spark.createDataFrame([("d", 2, "c"), ("d", 0, "a"), ("d", 1, "b")], "doc_id STRING, pos INT, line STRING")
    assert assemble_paragraphs(lines).first().paras == ["a", "b", "c"]
