"""Text clean-up, splitting and joining."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from signalweave.functions.matching import as_column
from signalweave.functions.patterns import alternation, escape

# The clean-up patterns for text lines.
NUMBERS = r"\d+?\.\d+|\.\d+|\d+-\d+|\d+/\d+|\d+/|-\d+|\d+|½|¼|⅔|¾/"
NUMBER_START = r"(?=[\d.\-½¼⅔¾])"
LINE_NOISE = ("\uf0b7", "\x0c", "____")
NUMBERED_BRACKETS = r"\(.*?\d+.*?\)|\s\s+|\d/"
BRACKETS = r"\(.*?\)"

SENTENCE_END = r"([.!?])\s+"
SENTENCE_MARK = "\u0001"
HELD_PERIOD = "\u0002"
CLOSING = rf"([.,;:!?()\[\]\"]+)([\s{SENTENCE_MARK}]|\z)"
OPENING = rf"(^|[\s{SENTENCE_MARK}])([(\[\"]+)"


def strip_nbsp(c: Column | str) -> Column:
    """Remove no-break spaces at both ends (`trim` leaves them)."""
    return F.regexp_replace(as_column(c), "^\u00A0+|\u00A0+$", "")


def newline_to_space(c: Column | str) -> Column:
    return F.translate(as_column(c), "\n", " ")


def split_on(c: Column | str, delimiter: str) -> Column:
    """Split at a literal delimiter, trim the parts, drop blank ones."""
    parts = F.transform(F.split(as_column(c), escape(delimiter), -1), lambda p: F.trim(p))
    return F.filter(parts, lambda p: p != "")


def drop_brackets(c: Column | str) -> Column:
    return F.regexp_replace(as_column(c), BRACKETS, "")


def clean_line(c: Column | str, boilerplate: Sequence[str] = ()) -> Column:
    """Blank out numbers, layout noise, the given boilerplate phrases and numbered brackets."""
    noise = "|".join(escape(p) for p in (*LINE_NOISE, *boilerplate))
    line = F.regexp_replace(as_column(c), f"{NUMBER_START}(?:{NUMBERS})", " ")
    line = F.regexp_replace(line, noise, " ")
    return F.regexp_replace(line, NUMBERED_BRACKETS, " ")


def contains_any(c: Column | str, phrases: Iterable[str]) -> Column:
    """Whether any of the literal phrases occurs (case-sensitive)."""
    column = as_column(c)
    test = F.lit(False)
    for phrase in phrases:
        test = test | column.contains(phrase)
    return F.coalesce(test, F.lit(False))


def join_phrases(c: Column | str, phrases: Iterable[str]) -> Column:
    """Lower the text and write the blanks inside known phrases as `_`, longest phrase first."""
    column = F.lower(as_column(c))
    for phrase in sorted({p.lower() for p in phrases if " " in p}, key=lambda p: (-len(p), p)):
        column = F.replace(column, F.lit(phrase), F.lit(phrase.replace(" ", "_")))
    return column


def _mark_sentences(c: Column, abbreviations: Sequence[str] = ()) -> Column:
    if not abbreviations:
        return F.regexp_replace(c, SENTENCE_END, f"$1{SENTENCE_MARK}")
    # Periods of abbreviations are put aside while sentences are marked.
    words = alternation(sorted(abbreviations, key=lambda w: (-len(w), w)))
    held = F.regexp_replace(c, rf"""(?iu)(^|[\s"'(\[])({words})\.(?=\s)""", f"$1$2{HELD_PERIOD}")
    return F.translate(F.regexp_replace(held, SENTENCE_END, f"$1{SENTENCE_MARK}"), HELD_PERIOD, ".")


def sentences(c: Column | str, abbreviations: Sequence[str] = ()) -> Column:
    """Sentences: cut after . ! ? where white space follows, but not after an abbreviation's period.

    `abbreviations` are words without their last period, in any case; see `operators.abbreviations`.
    """
    return F.split(_mark_sentences(as_column(c), abbreviations), SENTENCE_MARK, -1)


def sentence_words(c: Column | str, abbreviations: Sequence[str] = ()) -> Column:
    """ARRAY of sentences, each an ARRAY of tokens; sentences are cut as by `sentences`.

    Tokens are separated by white space; punctuation around a word is a token of its own.  The
    expressions run over the whole text before it is split at single characters: a split at an
    expression would compile it for every sentence.
    """
    column = as_column(c)
    text = F.regexp_replace(_mark_sentences(column, abbreviations), CLOSING, " $1 $2")
    opens = column.contains("(") | column.contains("[") | column.contains('"')
    text = F.when(opens, F.regexp_replace(text, OPENING, "$1 $2 ")).otherwise(text)
    text = F.regexp_replace(text, r"[\t-\r]", " ")
    return F.transform(
        F.split(text, SENTENCE_MARK, -1), lambda s: F.array_remove(F.split(s, " ", -1), "")
    )


def word_count(c: Column | str) -> Column:
    """Number of white-space separated words; 0 for NULL."""
    return F.coalesce(F.regexp_count(as_column(c), F.lit(r"(?U)\S+")), F.lit(0))


def join_words(c: Column | str) -> Column:
    return F.array_join(as_column(c), " ")


def without_connectors(c: Column | str) -> Column:
    """Delete the word `and` and the sign `&` from a query term (whole words only)."""
    return F.regexp_replace(as_column(c), r"(?i)\band\b|&", "")


def split_document_name(c: Column | str) -> Column:
    """`series-file_part` to STRUCT<series_id, file_id>."""
    column = as_column(c)
    file_name = F.split_part(column, F.lit("-"), F.lit(2))
    return F.struct(
        F.split_part(column, F.lit("-"), F.lit(1)).alias("series_id"),
        F.split_part(file_name, F.lit("_"), F.lit(1)).alias("file_id"),
    )
