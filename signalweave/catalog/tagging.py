"""Tags, keyword counts, positions, AND keys, themes and boolean queries on documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalweave.catalog.tables import (
    DOCUMENT_MONTH_SQL,
    document_posts,
    sql_line,
    sql_pattern,
    sql_plain,
    table,
    text_table,
)
from signalweave.catalog.words import CASED_PLACES, GROUPS, PLACES, THEMES
from signalweave.functions.matching import count_all
from signalweave.functions.patterns import cooccurrence_pattern, inflected_pattern, word_pattern
from signalweave.functions.predicates import all_of, any_of, any_term, in_language, phrase, term
from signalweave.operators.enrich import related_ratio
from signalweave.operators.series import monthly_counts
from signalweave.operators.tagging import (
    add_match_map,
    add_multi_group,
    explode_positions,
    explode_tags,
    group_counts,
    keyword_frequency,
    tag_countries,
)
from signalweave.operators.terms import expand_terms, remap_keywords, tag_categories
from signalweave.operators.themes import add_hits, add_theme_tags, long_enough

INFLECTED_WORDS = ["er", "on", "pathetic"]
ORDERED_WORDS = ["the,of,was", "idiot"]
CATEGORIES = {"market": ["idiot", "license", "the on", "fiscal"], "nonmarket": ["worthless", "in the", "und die"]}
CONTEXT_WORDS = ["was", "from", "nicht"]
CONTEXT_FREE = ["worthless"]
EVENT_CATEGORIES = (
    ("market", "purchase"), ("market", "click"), ("nonmarket", "signup"), ("nonmarket", "click"),
)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return text_table(spark, folder, "documents", "doc_id").select("doc_id", "text")


def _places(spark: SparkSession, folder: str) -> DataFrame:
    return tag_countries(document_posts(spark, folder), PLACES, "text", "places", CASED_PLACES)


def multi_label_tags(spark: SparkSession, folder: str) -> DataFrame:
    return _places(spark, folder).select("doc_id", F.array_join("places", "|").alias("places"))


def tag_explode_counts(spark: SparkSession, folder: str) -> DataFrame:
    rows = explode_tags(_places(spark, folder).drop("text"), "places", "country")
    return monthly_counts(rows, ("time_month", "country", "source"), "doc_id")


def keyword_counts(spark: SparkSession, folder: str) -> DataFrame:
    words = [w for ws in GROUPS.values() for w in ws]
    docs = documents(spark, folder)
    return docs.select("doc_id", count_all("text", word_pattern(words)).alias("n"))


def keyword_group_dummies(spark: SparkSession, folder: str) -> DataFrame:
    return group_counts(documents(spark, folder), GROUPS).drop("text")


def multi_group_flag(spark: SparkSession, folder: str) -> DataFrame:
    counted = group_counts(documents(spark, folder), GROUPS)
    return add_multi_group(counted, list(GROUPS)).select("doc_id", "all_dummy")


def group_ratio(spark: SparkSession, folder: str) -> DataFrame:
    counted = group_counts(documents(spark, folder), GROUPS)
    ratios = related_ratio(counted, [f"{g}_dummy" for g in GROUPS])
    return ratios.select(*[F.round(c, 6).alias(c) for c in ratios.columns])


def keyword_frequency_query(spark: SparkSession, folder: str) -> DataFrame:
    return keyword_frequency(documents(spark, folder), GROUPS["licence"] + GROUPS["insult"])


def keyword_match_map(spark: SparkSession, folder: str) -> DataFrame:
    """The frequency map of each document, as rows."""
    mapped = add_match_map(documents(spark, folder), GROUPS["insult"])
    return mapped.select("doc_id", F.explode("matches").alias("keyword", "n"))


def keyword_positions(spark: SparkSession, folder: str) -> DataFrame:
    pattern = word_pattern(GROUPS["insult"] + GROUPS["licence"])
    return explode_positions(documents(spark, folder), pattern, ["doc_id"])


def and_keys(spark: SparkSession, folder: str) -> DataFrame:
    found = add_hits(documents(spark, folder), THEMES)
    return found.select(
        "doc_id", *[F.array_contains("hits", k).cast("int").alias(k) for k in THEMES.combined]
    )


def theme_keep(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder).filter(long_enough())
    tagged = add_theme_tags(add_hits(docs, THEMES), THEMES, list(THEMES.groups))
    kept = tagged.filter(F.col("keep_tag") > 0)
    return kept.select("doc_id", "Climate_Keys_tag", "Policy_Keys_tag", "keep_tag")


def boolean_query(spark: SparkSession, folder: str) -> DataFrame:
    docs = document_posts(spark, folder)
    wanted = all_of(
        in_language("en"),
        any_of(phrase("text", "of the"), all_of(term("text", "idiot"), term("text", "with"))),
        any_term("text", ["was", "from", "by"]),
        ~term("text", "license"),
    )
    return docs.filter(wanted).select("doc_id", "source")


def term_category_tags(spark: SparkSession, folder: str) -> DataFrame:
    tagged = tag_categories(documents(spark, folder), CATEGORIES, CONTEXT_WORDS, CONTEXT_FREE)
    return tagged.select("doc_id", F.array_join("categories", "|").alias("categories"))


def term_expansion(spark: SparkSession, folder: str) -> DataFrame:
    """Part names as terms of their type; names of size-1 parts need no context."""
    terms = table(spark, folder, "part").select(F.col("p_type").alias("category"), F.col("p_name").alias("term"))
    return expand_terms(terms, ["carbon", "climate", "green"], ["red widget", "small ring"])


def keyword_remap(spark: SparkSession, folder: str) -> DataFrame:
    sheet = spark.createDataFrame(list(EVENT_CATEGORIES), "group STRING, keyword STRING")
    counts = table(spark, folder, "events").groupBy("event_type").agg(F.count("event_id").alias("n"))
    mapped = remap_keywords(counts, "event_type", sheet)
    return mapped.groupBy("category").agg(F.sum("n").alias("n"))


def inflected_match(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return docs.select("doc_id", count_all("text", inflected_pattern(INFLECTED_WORDS)).alias("n"))


def ordered_cooccurrence(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return docs.select(
        "doc_id", count_all("text", cooccurrence_pattern(ORDERED_WORDS), clean=False).alias("n")
    )


QUERIES = {
    "multi_label_tags": multi_label_tags,
    "tag_explode_counts": tag_explode_counts,
    "keyword_counts": keyword_counts,
    "keyword_group_dummies": keyword_group_dummies,
    "multi_group_flag": multi_group_flag,
    "group_ratio": group_ratio,
    "keyword_frequency": keyword_frequency_query,
    "keyword_match_map": keyword_match_map,
    "keyword_positions": keyword_positions,
    "and_keys": and_keys,
    "theme_keep": theme_keep,
    "boolean_query": boolean_query,
    "term_category_tags": term_category_tags,
    "term_expansion": term_expansion,
    "keyword_remap": keyword_remap,
    "inflected_match": inflected_match,
    "ordered_cooccurrence": ordered_cooccurrence,
}

_LINES = f"lines AS (SELECT doc_id, source, lang, text, {sql_line()} AS t, {sql_plain()} AS raw FROM documents)"


def _count(words, plural: bool = False, suffixes: str = "") -> str:
    return f"CAST(len(regexp_extract_all(t, {sql_pattern(words, plural, suffixes)})) AS INTEGER)"


def _has(words, column: str = "t", plural: bool = False, casing: bool = False) -> str:
    return f"regexp_matches({column}, {sql_pattern(words, plural, casing=casing)})"


_PLACES_SQL = ", ".join(
    f"CASE WHEN {_has(ws, 'raw', True, place in CASED_PLACES)} THEN '{place}' END" for place, ws in PLACES.items()
)
_DUMMIES_SQL = ", ".join(f"{_count(ws)} AS {g}_count" for g, ws in GROUPS.items())
_ALL_WORDS = [w for ws in GROUPS.values() for w in ws]
_POSITION_WORDS = GROUPS["insult"] + GROUPS["licence"]
_SEARCH = f"regexp_extract_all(lower(t), {sql_pattern(THEMES.search_words)})"


def _satisfied(key: str) -> str:
    parts = THEMES.combined.get(key, [key])
    return "(" + " AND ".join(f"list_contains(w, '{p}')" for p in parts) + ")"


_THEME_SQL = {t: " OR ".join(_satisfied(k) for k in ks) for t, ks in THEMES.groups.items()}


def _category_sql(category: str) -> str:
    terms = CATEGORIES[category]
    tests = [
        _has([t], "raw") if t in CONTEXT_FREE else f"({_has([t], 'raw')} AND {_has(CONTEXT_WORDS, 'raw')})"
        for t in terms
    ]
    return f"CASE WHEN {' OR '.join(tests)} THEN '{category}' END"


ORACLE = {
    "multi_label_tags": f"WITH {_LINES} SELECT doc_id, concat_ws('|', {_PLACES_SQL}) AS places FROM lines",
    "tag_explode_counts": f"""WITH {_LINES},
tagged AS (SELECT doc_id, source, unnest([{_PLACES_SQL}]) AS country FROM lines)
SELECT {DOCUMENT_MONTH_SQL} AS time_month, country, source, count(doc_id) AS id_count
FROM tagged WHERE country IS NOT NULL GROUP BY ALL""",
    "keyword_counts": f"WITH {_LINES} SELECT doc_id, {_count(_ALL_WORDS, True)} AS n FROM lines",
    "keyword_group_dummies": f"""WITH {_LINES}, c AS (SELECT doc_id, {_DUMMIES_SQL} FROM lines)
SELECT *, {', '.join(f'CAST({g}_count > 0 AS INTEGER) AS {g}_dummy' for g in GROUPS)} FROM c""",
    "multi_group_flag": f"""WITH {_LINES}, c AS (SELECT doc_id, {_DUMMIES_SQL} FROM lines)
SELECT doc_id, CAST({' + '.join(f'CAST({g}_count > 0 AS INTEGER)' for g in GROUPS)} > 1 AS INTEGER) AS all_dummy
FROM c""",
    "group_ratio": f"""WITH {_LINES}, c AS (SELECT doc_id, {_DUMMIES_SQL} FROM lines)
SELECT {', '.join(f'round(avg(CAST({g}_count > 0 AS INTEGER)), 6) AS {g}_dummy_ratio' for g in GROUPS)} FROM c""",
    "keyword_frequency": f"""WITH {_LINES},
m AS (SELECT unnest(regexp_extract_all(t, {sql_pattern(GROUPS['licence'] + GROUPS['insult'], True)})) AS keyword FROM lines)
SELECT keyword, count(*) AS n FROM m GROUP BY keyword""",
    "keyword_match_map": f"""WITH {_LINES},
m AS (SELECT doc_id, unnest(regexp_extract_all(t, {sql_pattern(GROUPS['insult'], True)})) AS keyword FROM lines)
SELECT doc_id, keyword, CAST(count(*) AS INTEGER) AS n FROM m GROUP BY ALL""",
    "keyword_positions": f"""WITH {_LINES},
cut AS (
  SELECT doc_id, regexp_extract_all(t, {sql_pattern(_POSITION_WORDS, True)}) AS found,
         string_split(regexp_replace(t, {sql_pattern(_POSITION_WORDS, True)}, chr(1), 'g'), chr(1)) AS pieces
  FROM lines),
spans AS (
  SELECT doc_id, unnest(found) AS match, unnest(list_transform(pieces[1:len(found)], lambda p: length(p))) AS gap,
         generate_subscripts(found, 1) AS i
  FROM cut)
SELECT doc_id, match, CAST(sum(gap + length(match)) OVER (PARTITION BY doc_id ORDER BY i) - length(match) AS INTEGER) AS start
FROM spans""",
    "and_keys": f"""WITH {_LINES}, s AS (SELECT doc_id, {_SEARCH} AS w FROM lines)
SELECT doc_id, {', '.join(f'CAST({_satisfied(k)} AS INTEGER) AS "{k}"' for k in THEMES.combined)} FROM s""",
    "theme_keep": f"""WITH {_LINES}, s AS (SELECT doc_id, {_SEARCH} AS w FROM lines WHERE length(text) > 5)
SELECT doc_id, 1 AS "Climate_Keys_tag", 1 AS "Policy_Keys_tag", 1 AS keep_tag
FROM s WHERE ({_THEME_SQL['Climate_Keys']}) AND ({_THEME_SQL['Policy_Keys']})""",
    "boolean_query": f"""WITH {_LINES}
SELECT doc_id, source FROM lines
WHERE lang = 'en' AND ({_has(['of the'], 'raw')} OR ({_has(['idiot'], 'raw')} AND {_has(['with'], 'raw')}))
  AND {_has(['was', 'from', 'by'], 'raw')} AND NOT {_has(['license'], 'raw')}""",
    "term_category_tags": f"""WITH {_LINES}
SELECT doc_id, concat_ws('|', {', '.join(_category_sql(c) for c in CATEGORIES)}) AS categories FROM lines""",
    "term_expansion": """SELECT DISTINCT p_type AS category,
  unnest(CASE WHEN p_name IN ('red widget', 'small ring') THEN [p_name]
         ELSE [p_name || ' carbon', p_name || ' climate', p_name || ' green'] END) AS query
FROM part""",
    "keyword_remap": f"""SELECT category, count(event_id) AS n
FROM events LEFT JOIN (VALUES {', '.join(str(p) for p in EVENT_CATEGORIES)}) AS m(category, keyword)
  ON event_type = keyword GROUP BY category""",
    "inflected_match": f"""WITH {_LINES}
SELECT doc_id, {_count(INFLECTED_WORDS, suffixes='(?:s|es|ly|ing)?')} AS n FROM lines""",
    "ordered_cooccurrence": f"""WITH {_LINES}
SELECT doc_id, CAST(len(regexp_extract_all(raw, {sql_pattern(['the.*?of.*?was', 'idiot'], suffixes='(?:s|es|ly|ing)?')})) AS INTEGER) AS n
FROM lines""",
}
