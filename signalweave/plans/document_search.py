"""Keyword-in-context search over documents with include and exclude words."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalweave.functions.text import join_phrases
from signalweave.operators.documents import check_context, document_text, keyword_windows
from signalweave.sources.dictionaries import Rule


def search_documents(
    docs: DataFrame, rules: Sequence[Rule], window: int = 30, negation_window: int = 10
) -> DataFrame:
    """(doc_id, paras) to one row per keyword occurrence with its context and flags.

    Rule anchors are `_`-joined phrases.
    """
    phrases = [r.anchor.replace("_", " ") for r in rules]
    texts = docs.select("doc_id", join_phrases(document_text(), phrases).alias("text"))
    found = check_context(keyword_windows(texts, rules, window=window, negation_window=negation_window), rules)
    return found.select(
        "doc_id",
        F.col("surface").alias("search_key"),
        "context_key",
        "exclude_keys",
        F.col("sentence").alias("sentence_content"),
        F.col("window").alias("range_content"),
        "sentence_match",
        "range_match",
        F.col("exclude_match").alias("exclude"),
    )
