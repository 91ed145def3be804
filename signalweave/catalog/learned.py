"""Language model and abbreviations, learnt from the documents and applied to them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalweave.catalog.tables import text_table
from signalweave.functions.text import sentences
from signalweave.operators.abbreviations import CERTAIN, LEAST, THRESHOLD, abbreviation_scores, learn_abbreviations
from signalweave.operators.language_model import MARGIN, TRIGRAMS, UNIT, add_language, learn_languages

FOLDS = 5


def language_model(spark: SparkSession, folder: str) -> DataFrame:
    """The language of all documents; those of every fifth id take no part in learning."""
    docs = text_table(spark, folder, "documents", "doc_id").select("doc_id", "text", "lang")
    held_out = F.col("doc_id") % FOLDS == 0
    model = learn_languages(docs.filter(~held_out))
    return add_language(docs, model).select("doc_id", held_out.alias("held_out"), "lang", "language")


def abbreviated_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents in which the word "st" is written as the abbreviation "St."."""
    docs = text_table(spark, folder, "documents", "doc_id")
    return docs.select("doc_id", F.regexp_replace("text", r"(^|\s)st\s", "$1St. ").alias("text"))


def abbreviations(spark: SparkSession, folder: str) -> DataFrame:
    scores = abbreviation_scores(abbreviated_documents(spark, folder))
    return scores.filter(F.col("score") >= THRESHOLD).select("word", "n", "k", F.round("score", 6).alias("score"))


def learned_sentences(spark: SparkSession, folder: str) -> DataFrame:
    docs = abbreviated_documents(spark, folder)
    words = learn_abbreviations(docs)
    plain, learned = F.size(sentences("text")), F.size(sentences("text", words))
    return docs.select("doc_id", plain.alias("n_plain"), learned.alias("n_sentences"))


QUERIES = {"language_model": language_model, "abbreviations": abbreviations, "learned_sentences": learned_sentences}

_GRAMS = """(SELECT *, ' ' || regexp_replace(lower(text), '[^\\p{L}]+', ' ', 'g') || ' ' AS t FROM documents),
g AS (
  SELECT doc_id, lang, gram FROM (SELECT doc_id, lang, t, unnest(range(1, length(t) - 1)) AS i FROM d), (SELECT 1),
    LATERAL (SELECT substr(t, i, 3) AS gram) WHERE regexp_matches(gram, '^([^ ].[^ ]|[^ ]{2} | [^ ]{2})$'))"""

_TOKEN = r"""'^["''(\[]*(\p{L}+(?:\.\p{L}+)*)(\.?)["'',;:!?)\]]*$'"""
_ABBREVIATIONS = rf"""d AS (SELECT doc_id, regexp_replace(text, '(^|\s)st\s', '\1St. ', 'g') AS text FROM documents),
s AS (SELECT doc_id, regexp_split_to_array(text, '\s+') AS w FROM d),
e AS (SELECT unnest(w) AS token FROM s),
c AS (
  SELECT lower(regexp_extract(token, {_TOKEN}, 1)) AS word, count(*) AS n, count(*) FILTER (regexp_extract(token, {_TOKEN}, 2) = '.') AS k
  FROM e GROUP BY 1 HAVING word <> ''),
p AS (SELECT sum(k)::DOUBLE / sum(n)::DOUBLE AS p FROM c),
a AS (
  SELECT word, n, k, length(word) - length(replace(word, '.', '')) AS inside,
         2 * (k * (ln({CERTAIN}) - ln(p)) + (n - k) * (ln(1 - {CERTAIN}) - ln(1 - p))) AS ratio
  FROM c, p WHERE n >= {LEAST} AND k > 0),
b AS (
  SELECT word, n, k, round(ratio * exp(-(length(word) - inside)) * (inside + 1)
         * pow((length(word) - inside)::DOUBLE, -(n - k)::DOUBLE), 9) AS score FROM a)"""

ORACLE = {
    "language_model": f"""WITH d AS {_GRAMS},
n AS (SELECT gram, lang, count(*) AS n FROM g WHERE doc_id % {FOLDS} <> 0 GROUP BY ALL),
best AS (SELECT gram FROM n GROUP BY gram ORDER BY sum(n) DESC, gram LIMIT {TRIGRAMS}),
langs AS (SELECT DISTINCT lang FROM documents WHERE doc_id % {FOLDS} <> 0),
m AS (SELECT gram, langs.lang, coalesce(n, 0) AS n FROM best CROSS JOIN langs LEFT JOIN n USING (gram, lang)),
w AS (
  SELECT gram, lang, round(ln((n + 1)::DOUBLE / (sum(n) OVER (PARTITION BY lang) + {TRIGRAMS})::DOUBLE) * {UNIT})::BIGINT AS w FROM m),
s AS (SELECT doc_id, w.lang, sum(w) AS s, count(*) AS n FROM g JOIN w USING (gram) GROUP BY ALL),
r AS (
  SELECT doc_id, lang AS language, s - lead(s) OVER o AS lead, n, row_number() OVER o AS r
  FROM s WINDOW o AS (PARTITION BY doc_id ORDER BY s DESC, lang))
SELECT doc_id, doc_id % {FOLDS} = 0 AS held_out, lang,
       CASE WHEN language IS NULL OR lead < n * {MARGIN} THEN 'NA' ELSE language END AS language
FROM documents LEFT JOIN r USING (doc_id) WHERE r IS NULL OR r = 1""",
    "abbreviations": f"""WITH {_ABBREVIATIONS}
SELECT word, n, k, round(score, 6) AS score FROM b WHERE score >= {THRESHOLD}""",
    "learned_sentences": rf"""WITH {_ABBREVIATIONS},
good AS (SELECT list(word) AS words FROM b WHERE score >= {THRESHOLD}),
t AS (SELECT doc_id, [x for x in w[:len(w) - 1] if regexp_matches(x, '[.!?]$')] AS ends FROM s)
SELECT doc_id, (1 + len(ends))::INTEGER AS n_plain,
       (1 + len([x for x in ends if NOT (x LIKE '%.' AND list_contains(words, lower(regexp_replace(x, '^["''(\[]*(.*)\.$', '\1'))))]))::INTEGER AS n_sentences
FROM t, good""",
}
