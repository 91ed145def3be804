"""Counts, shares, trailing statistics and quartiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalweave.catalog.tables import (
    DOCUMENT_MONTH_SQL,
    LABELLED_POSTS_SQL,
    document_posts,
    labelled_posts,
    sql_line,
    sql_pattern,
    table,
)
from signalweave.catalog.words import BOOK
from signalweave.operators.series import (
    COUNT_KEYS,
    counts_with_share,
    merge_counts,
    monthly_counts,
    pivot_share,
    quartiles,
    trailing_stats,
)
from signalweave.operators.rules import explain_policy
from signalweave.plans.policies import policy_series as build_policy_series
from signalweave.plans.sentiment import sentiment_series as build_sentiment_series


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a comparable precision."""
    return df.select(
        *[F.round(F.col(f"`{n}`"), digits).alias(n) if t == "double" else F.col(f"`{n}`") for n, t in df.dtypes]
    )


def monthly_counts_query(spark: SparkSession, folder: str) -> DataFrame:
    return monthly_counts(labelled_posts(spark, folder))


def monthly_partial_final(spark: SparkSession, folder: str) -> DataFrame:
    """Counts per year of the id range first, as stored partials would be, then the final counts."""
    posts = labelled_posts(spark, folder).withColumn("part", F.pmod("id", F.lit(4)))
    return merge_counts(monthly_counts(posts, ("part", *COUNT_KEYS)))


def monthly_pivot_share(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(pivot_share(monthly_counts(labelled_posts(spark, folder))))


def sentiment_series(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(build_sentiment_series(labelled_posts(spark, folder)))


def series_by_country(spark: SparkSession, folder: str) -> DataFrame:
    wide = counts_with_share(labelled_posts(spark, folder), keys=("country", "time_month"))
    return rounded(trailing_stats(wide, group_keys=("country",)))


def country_quartiles(spark: SparkSession, folder: str) -> DataFrame:
    wide = counts_with_share(labelled_posts(spark, folder))
    return rounded(quartiles(wide.select("country", "category", "time_month", "negative_share")))


def policy_series(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels").select("doc_id", F.col("toxic").alias("negative"))
    posts = document_posts(spark, folder).join(labels, "doc_id").select(
        F.col("doc_id").alias("id"), F.col("lang").alias("country"), "negative", "time_month", "text"
    )
    return rounded(build_policy_series(posts, BOOK, text="text"))


def policy_match_explain(spark: SparkSession, folder: str) -> DataFrame:
    docs = document_posts(spark, folder).select("doc_id", "text")
    found = explain_policy(docs, BOOK["conduct"])
    return found.select(
        "doc_id",
        "status",
        F.array_join("anchor_check", "|").alias("anchor_check"),
        F.array_join("include_check", "|").alias("include_check"),
    )


QUERIES = {
    "monthly_counts": monthly_counts_query,
    "monthly_partial_final": monthly_partial_final,
    "monthly_pivot_share": monthly_pivot_share,
    "sentiment_series": sentiment_series,
    "series_by_country": series_by_country,
    "country_quartiles": country_quartiles,
    "policy_series": policy_series,
    "policy_match_explain": policy_match_explain,
}

_COUNTS_SQL = f"""WITH {LABELLED_POSTS_SQL}
SELECT time_month, country, category, negative, count(id) AS id_count
FROM posts GROUP BY ALL"""


def _wide_sql(keys: str) -> str:
    return f"""wide AS (
  SELECT {keys}, count(*) FILTER (negative = 0) AS "neutral-positive",
         count(*) FILTER (negative = 1) AS negative
  FROM posts GROUP BY {keys}),
shares AS (
  SELECT *, CAST(negative AS DOUBLE) / (negative + "neutral-positive") AS negative_share FROM wide)"""


def _series_sql(keys: str, groups: str, source: str) -> str:
    return f"""WITH {source},
{_wide_sql(keys)},
stats AS (
  SELECT *, avg(negative_share) OVER w AS ma, stddev_samp(negative_share) OVER w AS sd
  FROM shares
  WINDOW w AS (PARTITION BY {groups} ORDER BY time_month ROWS BETWEEN 11 PRECEDING AND CURRENT ROW))
SELECT {keys}, "neutral-positive", negative, round(negative_share, 6) AS negative_share,
       round(ma, 6) AS "12m_ma", round(sd, 6) AS "12m_sd",
       coalesce(CASE WHEN sd > 0 THEN round((negative_share - ma) / sd, 9) > 1 END, false) AS up_over_1sd
FROM stats"""


def _status_sql(rules) -> str:
    """Anchors of one left-to-right search, then the condition of each."""
    anchors = f"regexp_extract_all(t, {sql_pattern([r.anchor for r in rules])})"
    tests = []
    for r in rules:
        test = [f"list_contains({anchors}, '{r.anchor}')"]
        if r.include:
            test.append(f"regexp_matches(t, {sql_pattern(r.include)})")
        if r.exclude:
            test.append(f"NOT regexp_matches(t, {sql_pattern(r.exclude)})")
        tests.append("(" + " AND ".join(test) + ")")
    return " OR ".join(tests)


_POLICY_POSTS_SQL = f"""lines AS (
  SELECT doc_id AS id, lang AS country, toxic AS negative, {DOCUMENT_MONTH_SQL} AS time_month,
         lower({sql_line()}) AS t
  FROM documents JOIN labels USING (doc_id)),
posts AS (""" + " UNION ALL ".join(
    f"SELECT '{policy}' AS policy, country, negative, time_month FROM lines WHERE {_status_sql(rules)}"
    for policy, rules in BOOK.items()
) + ")"


def _explain_sql(rules) -> str:
    known = ", ".join(f"'{r.anchor}'" for r in rules)
    permitted = []
    for r in rules:
        test = ["true"]
        if r.include:
            test.append(f"regexp_matches(t, {sql_pattern(r.include)})")
        if r.exclude:
            test.append(f"NOT regexp_matches(t, {sql_pattern(r.exclude)})")
        permitted.append(f"WHEN a = '{r.anchor}' THEN {' AND '.join(test)}")
    evidence = " ".join(
        f"WHEN hit = '{r.anchor}' THEN regexp_extract_all(t, {sql_pattern(r.include)})"
        for r in rules if r.include
    )
    return f"""WITH lines AS (SELECT doc_id, lower({sql_line()}) AS t FROM documents),
found AS (
  SELECT doc_id, t, unnest(regexp_extract_all(t, {sql_pattern([r.anchor for r in rules])})) AS a,
         generate_subscripts(regexp_extract_all(t, {sql_pattern([r.anchor for r in rules])}), 1) AS i
  FROM lines),
firsts AS (
  SELECT doc_id, t, a, min(i) AS i FROM found WHERE a IN ({known}) GROUP BY ALL),
judged AS (SELECT *, CASE {' '.join(permitted)} END AS ok FROM firsts),
docs AS (
  SELECT doc_id, any_value(t) AS t, string_agg(a, '|' ORDER BY i) AS every_anchor,
         arg_min(a, i) FILTER (ok) AS hit
  FROM judged GROUP BY doc_id),
words AS (
  SELECT doc_id, unnest(ev) AS w, generate_subscripts(ev, 1) AS j
  FROM (SELECT doc_id, CASE {evidence} END AS ev FROM docs)),
listed AS (
  SELECT doc_id, string_agg(w, '|' ORDER BY j) AS include_check
  FROM (SELECT doc_id, w, min(j) AS j FROM words GROUP BY ALL) GROUP BY doc_id)
SELECT d.doc_id, coalesce(hit IS NOT NULL, false) AS status,
       coalesce(hit, every_anchor, '') AS anchor_check, include_check
FROM documents d LEFT JOIN docs USING (doc_id) LEFT JOIN listed USING (doc_id)"""


ORACLE = {
    "monthly_counts": _COUNTS_SQL,
    "monthly_partial_final": _COUNTS_SQL,
    "monthly_pivot_share": f"""WITH {LABELLED_POSTS_SQL},
{_wide_sql("country, category, time_month")}
SELECT country, category, time_month, "neutral-positive", negative,
       round(negative_share, 6) AS negative_share FROM shares""",
    "sentiment_series": _series_sql(
        "country, category, time_month", "country, category", LABELLED_POSTS_SQL
    ),
    "series_by_country": _series_sql("country, time_month", "country", LABELLED_POSTS_SQL),
    "country_quartiles": f"""WITH {LABELLED_POSTS_SQL},
{_wide_sql("country, category, time_month")},
q AS (SELECT category, time_month, quantile_cont(negative_share, 0.25) AS q25,
             quantile_cont(negative_share, 0.5) AS q50, quantile_cont(negative_share, 0.75) AS q75
      FROM shares GROUP BY ALL)
SELECT country, category, time_month, round(negative_share, 6) AS negative_share,
       round(q25, 6) AS percentile_25, round(q50, 6) AS percentile_50, round(q75, 6) AS percentile_75
FROM shares JOIN q USING (category, time_month)""",
    "policy_series": _series_sql("policy, country, time_month", "policy, country", _POLICY_POSTS_SQL),
    "policy_match_explain": _explain_sql(BOOK["conduct"]),
}
