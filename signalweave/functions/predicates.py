"""Search conditions on posts, composed with & and | like any other Column.

`all_of(phrase("text", "green certificates"), any_of(term("text", "carbon"), ...))` is the
DataFrame form of a boolean keyword query: blank = AND, OR, parentheses, quoted phrase, #tag.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from signalweave.functions.matching import as_column, contains_match
from signalweave.functions.patterns import ANY_CASE, escape, word_pattern


def term(text: Column | str, word: str) -> Column:
    """The word or phrase occurs as whole words, in any case."""
    return contains_match(text, word_pattern([word], plural=False))


phrase = term


def any_term(text: Column | str, words: list[str]) -> Column:
    """One of the words occurs: a single pattern instead of one test per word."""
    return contains_match(text, word_pattern(words, plural=False))


def all_terms(text: Column | str, words: list[str]) -> Column:
    return all_of(*[term(text, w) for w in words])


def all_of(*conditions: Column) -> Column:
    return reduce(and_, conditions, F.lit(True))


def any_of(*conditions: Column) -> Column:
    return reduce(or_, conditions, F.lit(False))


def hashtag(text: Column | str, tag: str) -> Column:
    return contains_match(text, rf"{ANY_CASE}#{escape(tag.lstrip('#'))}\b")


def mentions(text: Column | str, user: str) -> Column:
    """`@user` not preceded by a word character."""
    return contains_match(text, rf"{ANY_CASE}(?<!\w)@{escape(user.lstrip('@'))}\b")


def not_repost(referenced: Column | str = "referenced_tweets") -> Column:
    """No reference of type `retweeted`; posts without references pass."""
    return ~F.coalesce(F.exists(as_column(referenced), lambda r: r["type"] == "retweeted"), F.lit(False))


def in_place(code: str, geo: Column | str = "geo") -> Column:
    return F.coalesce(as_column(geo)["country_code"] == code, F.lit(False))


def in_language(code: str, lang: Column | str = "lang") -> Column:
    return as_column(lang) == code


def by_author(author: str, column: Column | str = "author_id") -> Column:
    return as_column(column) == author


def is_root(id_col: str = "id", conversation: str = "conversation_id") -> Column:
    return F.col(id_col) == F.col(conversation)


def engaged(threshold: int = 1, metrics: Column | str = "public_metrics") -> Column:
    """Replies plus quotes reach the threshold; a missing counter counts as 0."""
    m = as_column(metrics)
    replies = F.coalesce(m["reply_count"], F.lit(0))
    quotes = F.coalesce(m["quote_count"], F.lit(0))
    return (replies + quotes) >= threshold
