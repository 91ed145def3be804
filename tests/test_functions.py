"""Text, date, literal and predicate columns."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from signalweave.functions import text as T
from signalweave.functions.literals import parse_list, parse_metrics
from signalweave.functions.predicates import (
    all_of, all_terms, any_of, any_term, by_author, engaged, hashtag, in_language, in_place, is_root,
    mentions, not_repost, phrase, term,
)
from signalweave.functions.temporal import to_day, to_month, within, year_ranges


def test_text_helpers(one):
    assert one("\u00a0key\u00a0", T.strip_nbsp("text")) == "key"
    assert one("a| b ||", T.split_on("text", "|")) == ["a", "b"]
    assert one("a (x 1) b", T.drop_brackets("text")) == "a  b"
    assert one("a\nb", T.newline_to_space("text")) == "a b"
    assert one("research and development & standards", T.without_connectors("text")) == "research  development  standards"
    assert one("Carbon Tax and carbon tax credit", T.join_phrases("text", ["carbon tax", "carbon tax credit"])) == (
        "carbon_tax and carbon_tax_credit"
    )
    assert tuple(one("s1-f2_x", T.split_document_name("text"))) == ("s1", "f2")
    assert one(" two  words ", T.word_count("text")) == 2
    assert one(None, T.word_count("text")) == 0
    assert one("keep ____ this", T.contains_any("text", ["____"])) is True
    assert one(None, T.contains_any("text", ["____"])) is False


@pytest.mark.parametrize(
    ("line", "expected"),
    [
        ("grew 3.5 percent", "grew percent"),
        ("pages 12-14 and 1/2", "pages and "),
        ("see (box 1) here", "see (box ) here"),
        (" item ____ x", " item x"),
    ],
)
def test_clean_line(one, line, expected):
    assert one(line, T.clean_line("text")) == expected


def test_clean_line_boilerplate(one):
    assert one("a HEADER b", T.clean_line("text", ["HEADER"])) == "a b"


def test_sentences_and_words(one):
    text = 'He said: "tax (now)". Then, no! Done?'
    assert one(text, T.sentences("text")) == ['He said: "tax (now)".', "Then, no!", "Done?"]
    tokens = one(text, T.sentence_words("text"))
    assert tokens[1] == ["Then", ",", "no", "!"]
    assert tokens[0][:4] == ["He", "said", ":", '"']
    assert "" not in [t for s in tokens for t in s]


def test_dates(one, spark):
    assert one("2020-03-31T10:00:00Z", to_day("text")) == dt.date(2020, 3, 31)
    assert one("not a date", to_day("text")) is None
    assert one("2020-03-31", to_month(to_day("text"))) == dt.date(2020, 3, 1)
    assert one("2020-12-31T23", within("text", "2020-01-01", "2021-01-01")) is True
    assert one("2021-01-01T00", within("text", "2020-01-01", "2021-01-01")) is False
    rows = year_ranges(spark, 2019, 2021).orderBy("year").collect()
    assert [(r.range_start, r.range_end) for r in rows] == [
        (dt.date(2019, 1, 1), dt.date(2020, 1, 1)), (dt.date(2020, 1, 1), dt.date(2021, 1, 1)),
    ]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("['china', 'iran']", ["china", "iran"]),
        ("[]", []),
        ('["cote d\'ivoire"]', ["cote d'ivoire"]),
        ("china", ["china"]),
        (None, None),
    ],
)
def test_parse_list(one, text, expected):
    assert one(text, parse_list("text")) == expected


def test_parse_metrics_keeps_the_rest_when_one_counter_is_none(one):
    metrics = one("{'reply_count': None, 'quote_count': 1}", parse_metrics("text"))
    assert metrics.reply_count is None and metrics.quote_count == 1
    assert one(None, parse_metrics("text")) is None


def test_boolean_queries(one):
    text = "Green certificates for carbon #Climate @Agency"
    assert one(text, all_of(phrase("text", "green certificates"), any_of(term("text", "co2"), term("text", "CARBON"))))
    assert one(text, any_term("text", ["co2", "carbon"])) and one(text, all_terms("text", ["green", "carbon"]))
    assert not one(text, all_of(term("text", "certificate")))
    assert one(text, hashtag("text", "climate")) and not one("climate", hashtag("text", "#climate"))
    assert one(text, mentions("text", "@agency")) and not one("x@agency", mentions("text", "agency"))
    assert one(text, all_of()) is True and one(text, any_of()) is False


def test_post_predicates(spark):
    schema = (
        "id STRING, conversation_id STRING, author_id STRING, lang STRING, geo STRUCT<country_code: STRING>, "
        "public_metrics STRUCT<reply_count: BIGINT, quote_count: BIGINT>, "
        "referenced_tweets ARRAY<STRUCT<type: STRING, id: STRING>>"
    )
    rows = [
        ("1", "1", "a", "en", ("AR",), (0, None), None),
        ("2", "1", "b", "es", None, (1, 0), [("retweeted", "9")]),
        ("3", "3", "a", "en", ("BR",), None, [("quoted", "1")]),
    ]
    df = spark.createDataFrame(rows, schema)
    ids = lambda condition: {r.id for r in df.filter(condition).collect()}
    assert ids(is_root()) == {"1", "3"}
    assert ids(engaged(1)) == {"2"} and ids(engaged(0)) == {"1", "2", "3"}
    assert ids(not_repost()) == {"1", "3"}
    assert ids(in_place("AR")) == {"1"}
    assert ids(in_language("en") & by_author("a")) == {"1", "3"}
    assert ids(F.lit(True)) == {"1", "2", "3"}
