"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document.  The ledger keeps the measurements and one bit per
failed rule; a policy is a named mask of rules that count, so that applying another version of the
policy, or asking what a rule costs, is arithmetic on the bits and never reads a text again.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalweave.llm.frames import documents, map_texts

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long,"
    " n_repeat_words long, n_letters long, n_capitals long"
)

# Rules in bit order: a document fails a rule where the condition holds.
RULES: dict[str, Callable[[], Column]] = {
    "few_words": lambda: F.col("n_words") < 20,
    "repeated_windows": lambda: 100 * F.col("n_repeat_words") > 30 * F.col("n_words"),
    "many_symbols": lambda: 5 * F.col("n_symbols") > F.col("n_words"),
    "repeated_lines": lambda: 10 * F.col("n_dup_lines") > 6 * F.col("n_lines"),
    "mostly_capitals": lambda: 10 * F.col("n_capitals") > 6 * F.col("n_letters"),
    "word_length": lambda: (F.col("word_chars") < 2 * F.col("n_words"))
    | (F.col("word_chars") > 25 * F.col("n_words")),
}

# Versions of the policy: the rules that count.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "many_symbols", "mostly_capitals"),
    "v2": tuple(RULES),
}
CURRENT = "v2"


def mask(rules: tuple[str, ...]) -> int:
    order = list(RULES)
    return sum(1 << order.index(rule) for rule in rules)


def repeated_words(words: list[bytes], size: int = WINDOW) -> int:
    """Words inside windows of `size` words that occur twice or more, first occurrences included."""
    n = len(words)
    if n <= size:
        return 0
    one = np.fromiter(map(hash, words), np.int64, n).view(np.uint64)
    key = np.zeros(n - size + 1, np.uint64)
    for j in range(size):
        key = key * np.uint64(0x9E3779B97F4A7C15) + one[j : n - size + 1 + j]
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    if not same.any():
        return 0
    likely = np.zeros(len(key), bool)
    likely[order[1:][same]] = True
    likely[order[:-1][same]] = True
    # Equal hashes only propose: windows count when their words are equal.
    places: dict[tuple[bytes, ...], list[int]] = {}
    for at in np.flatnonzero(likely).tolist():
        places.setdefault(tuple(words[at : at + size]), []).append(at)
    edges = np.zeros(n + 1, np.int64)
    for starts in places.values():
        if len(starts) > 1:
            edges[starts] += 1
            edges[np.asarray(starts) + size] -= 1
    return int((np.cumsum(edges) > 0).sum())


def measure(text: bytes) -> tuple[int, ...]:
    """The measurements of one text in the order of MEASURES; an empty text measures zero."""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    units = np.frombuffer(text, np.uint8)
    # Code points: bytes other than UTF-8 continuation bytes.
    chars = int(((units & 0xC0) != 0x80).sum())
    blanks = len(text) - sum(map(len, words))
    letters = int((((units | 32) >= 97) & ((units | 32) <= 122)).sum())
    capitals = int(((units >= 65) & (units <= 90)).sum())
    return (
        len(words),
        chars - blanks,
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeated_words(words),
        letters,
        capitals,
    )


def measurements(
    df: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text"
) -> DataFrame:
    """One row of measurements per document; a NULL text measures like an empty one."""

    def values():
        return lambda texts: zip(*map(measure, texts))

    return map_texts(df, MEASURES, values, text, keep)


def ledger(
    df: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text"
) -> DataFrame:
    """Measurements and `failures`: bit i is set where the i-th rule fails.

    Rows are independent: repeated ids give repeated rows, a NULL id stays NULL, an empty table
    gives an empty ledger, and columns other than the kept ones and the text are not read.
    """
    bits = F.lit(0).cast("long")
    for i, failed in enumerate(RULES.values()):
        bits = bits + F.when(failed(), F.lit(1 << i)).otherwise(F.lit(0)).cast("long")
    return measurements(df, keep, text).withColumn("failures", bits)


def apply_policy(entries: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Add `kept`: no rule of the policy failed."""
    wanted = mask(POLICIES[policy])
    return entries.withColumn("kept", F.col("failures").bitwiseAND(wanted) == 0)


def ablations(entries: DataFrame) -> DataFrame:
    """Per policy and rule of it: documents kept, and documents kept if that rule did not count.

    Documents are first counted by bit pattern, of which there are at most 2 to the number of
    rules; the rest is bit arithmetic on those few rows.
    """
    patterns = entries.groupBy("failures").agg(F.count(F.lit(1)).alias("n"))
    cases = [
        F.struct(
            F.lit(policy).alias("policy"),
            F.lit(rule).alias("rule"),
            F.lit(mask(rules)).cast("long").alias("all"),
            F.lit(mask(rules) & ~mask((rule,))).cast("long").alias("without"),
        )
        for policy, rules in POLICIES.items()
        for rule in rules
    ]
    each = patterns.select("failures", "n", F.explode(F.array(*cases)).alias("case"))

    def passing(which: str) -> Column:
        return F.sum(F.when(F.col("failures").bitwiseAND(F.col(f"case.{which}")) == 0, F.col("n")).otherwise(0))

    return each.groupBy(F.col("case.policy").alias("policy"), F.col("case.rule").alias("rule")).agg(
        F.sum("n").alias("documents"),
        passing("all").alias("kept"),
        passing("without").alias("kept_without"),
    )


def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    entries = apply_policy(ledger(documents(spark, folder)))
    base = F.col("failures").bitwiseAND(mask(POLICIES["base"])) != 0
    return entries.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), "kept", "failures",
    )


def accepted(df: DataFrame, policy: str = CURRENT) -> DataFrame:
    """The rows of `df` that pass the policy, with all their columns, whatever these are called."""
    plain = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    entries = ledger(plain, tuple(plain.columns), f"_c{df.columns.index('text')}")
    return apply_policy(entries, policy).filter("kept").select(plain.columns).toDF(*df.columns)


ORACLE = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         [x for x in string_split(coalesce(text, ''), chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] AS l
  FROM documents),
k AS (
  SELECT doc_id, i, array_to_string(w[i : i + 7], ' ') AS key
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM w WHERE len(w) >= 8)),
r AS (SELECT doc_id, i FROM k QUALIFY count(*) OVER (PARTITION BY doc_id, key) > 1),
c AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM r, range(8) AS s(j) GROUP BY doc_id),
m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum([length(x) for x in w]), 0)::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l) AS n_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words,
         length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS letters, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS capitals
  FROM w LEFT JOIN c USING (doc_id)),
b AS (
  SELECT *, (n_words < 20)::BIGINT + 2 * (100 * n_repeat_words > 30 * n_words)::BIGINT
         + 4 * (5 * n_symbols > n_words)::BIGINT + 8 * (10 * n_dup_lines > 6 * n_lines)::BIGINT
         + 16 * (10 * capitals > 6 * letters)::BIGINT
         + 32 * (word_chars < 2 * n_words OR word_chars > 25 * n_words)::BIGINT AS failures
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       failures & 3 <> 0 AS base_failed, failures = 0 AS kept, failures
FROM b
"""
