"""Dictionaries and stored queries that are tables, over documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalweave.catalog.tables import sql_plain, table, text_table
from signalweave.operators.large_dictionaries import percolate, tag_by_dictionary
from signalweave.sources.term_lists import (
    CONTEXT_FREE,
    CONTEXTS,
    FURTHER_MARKET_TERMS,
    MARKET_TERMS,
    NONMARKET_TERMS,
)

TERMS = [
    (category, term, term in CONTEXT_FREE or term in FURTHER_MARKET_TERMS)
    for category, terms in (("market", MARKET_TERMS + FURTHER_MARKET_TERMS), ("nonmarket", NONMARKET_TERMS))
    for term in terms
]


def alias_dictionary(spark: SparkSession, folder: str) -> DataFrame:
    """Part names by their type, and word pairs and words of the benchmark by the item's number."""
    parts = table(spark, folder, "part").select(F.col("p_type").alias("name"), F.col("p_name").alias("alias"))
    words = F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0))
    items = table(spark, folder, "benchmark").select(F.concat(F.lit("item "), F.col("item_id")).alias("name"), words.alias("w"))
    pair = F.concat_ws(" ", F.get("w", F.lit(0)), F.get("w", F.lit(1)))
    aliases = F.array(pair, F.concat_ws(" ", F.get("w", F.lit(3)), F.get("w", F.lit(4)), F.get("w", F.lit(5))), F.get("w", F.lit(7)))
    # The aliases of every fourth item respect letter case.
    cased = F.expr("cast(substring(name, 6) as bigint) % 4 = 0")
    return parts.withColumn("cased", F.lit(False)).union(items.select("name", F.explode(aliases), cased))


def dictionary_tags(spark: SparkSession, folder: str) -> DataFrame:
    docs = text_table(spark, folder, "documents", "doc_id").select("doc_id", "text")
    tagged = tag_by_dictionary(docs, alias_dictionary(spark, folder))
    return tagged.select("doc_id", F.array_join("tags", "|").alias("tags"))


def stored_queries(spark: SparkSession, folder: str) -> DataFrame:
    """All terms, each with every context word unless it needs none, and one query of the words of each benchmark item."""
    rows = []
    for category, term, alone in TERMS:
        if alone:
            rows.append((f"{category}: {term}", [[term]], []))
        else:
            rows += [(f"{category}: {term} + {context}", [[term], [context]], []) for context in CONTEXTS]
    fixed = spark.createDataFrame(rows, "query_id STRING, clauses ARRAY<ARRAY<STRING>>, excluded ARRAY<STRING>")
    w = F.regexp_extract_all("text", F.lit("[A-Za-z]+"), F.lit(0))

    def word(i: int):
        return F.get(w, F.lit(i))

    pair = F.concat_ws(" ", word(0), word(1))
    items = table(spark, folder, "benchmark").select(
        F.concat(F.lit("item: "), F.col("item_id")).alias("query_id"),
        F.array(F.array(pair, word(2)), F.array(word(3), word(4))).alias("clauses"),
        F.array(word(5)).alias("excluded"),
    )
    return fixed.union(items)


def percolated_queries(spark: SparkSession, folder: str) -> DataFrame:
    docs = text_table(spark, folder, "documents", "doc_id").select("doc_id", "text")
    return percolate(docs, stored_queries(spark, folder), "doc_id")


QUERIES = {"dictionary_tags": dictionary_tags, "percolated_queries": percolated_queries}

_ESCAPED = r"regexp_replace({}, '([^\w\s])', '\\\1', 'g')"
_TERMS_SQL = ", ".join(f"('{c}', '{t}', {str(alone).lower()})" for c, t, alone in TERMS)
_CONTEXTS_SQL = ", ".join(f"'{c}'" for c in CONTEXTS)

ORACLE = {
    "dictionary_tags": rf"""WITH docs AS (SELECT doc_id, {sql_plain()} AS t FROM documents),
items AS (SELECT 'item ' || item_id AS name, item_id % 4 = 0 AS cased, regexp_extract_all(text, '[A-Za-z]+') AS w FROM benchmark),
aliases AS (
  SELECT DISTINCT p_type AS name, p_name AS alias, false AS cased FROM part UNION
  SELECT name, unnest([concat_ws(' ', w[1], w[2]), concat_ws(' ', w[4], w[5], w[6]), w[8]]), cased FROM items),
hits AS (
  SELECT DISTINCT doc_id, name FROM docs, aliases
  WHERE trim(alias) <> '' AND regexp_matches(t, CASE WHEN cased THEN '' ELSE '(?i)' END || '\b' || {_ESCAPED.format('alias')} || '(?:s|es)?\b'))
SELECT doc_id, coalesce(string_agg(name, '|' ORDER BY name), '') AS tags FROM docs LEFT JOIN hits USING (doc_id) GROUP BY doc_id""",
    "percolated_queries": rf"""WITH docs AS (SELECT doc_id, {sql_plain()} AS t FROM documents),
terms(category, term, alone) AS (VALUES {_TERMS_SQL}),
fixed AS (
  SELECT category || ': ' || term AS query_id, [[term]] AS clauses, [] AS excluded FROM terms WHERE alone UNION ALL
  SELECT category || ': ' || term || ' + ' || context, [[term], [context]], []
  FROM terms, (SELECT unnest([{_CONTEXTS_SQL}]) AS context) WHERE NOT alone),
items AS (SELECT 'item: ' || item_id AS query_id, regexp_extract_all(text, '[A-Za-z]+') AS w FROM benchmark),
queries AS (
  SELECT query_id, clauses, excluded::VARCHAR[] AS excluded FROM fixed UNION ALL
  SELECT query_id, [[concat_ws(' ', w[1], w[2]), w[3]], [w[4], w[5]]], [w[6]] FROM items),
q AS (SELECT query_id, len(clauses) AS n, unnest(range(1, len(clauses) + 1)) AS c, clauses FROM queries),
p AS (SELECT query_id, n, c, unnest(clauses[c]) AS phrase FROM q),
x AS (SELECT query_id, unnest(excluded) AS phrase FROM queries),
phrases AS (SELECT phrase FROM p UNION SELECT phrase FROM x),
hits AS (SELECT doc_id, phrase FROM docs, phrases WHERE regexp_matches(t, '(?i)\b' || {_ESCAPED.format('phrase')} || '\b')),
met AS (SELECT doc_id, query_id, n FROM p JOIN hits USING (phrase) GROUP BY doc_id, query_id, n HAVING count(DISTINCT c) = n)
SELECT doc_id, query_id FROM met
WHERE NOT EXISTS (SELECT 1 FROM x JOIN hits USING (phrase) WHERE x.query_id = met.query_id AND hits.doc_id = met.doc_id)""",
}
