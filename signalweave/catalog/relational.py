"""Joins, recodes, set operations, ranking and time ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalweave.catalog.tables import table
from signalweave.functions.literals import parse_list, parse_metrics
from signalweave.functions.predicates import engaged, in_place, mentions, not_repost
from signalweave.functions.temporal import within, year_ranges
from signalweave.operators.documents import strip_lookup
from signalweave.operators.enrich import (
    fill_counts,
    flatten,
    join_users,
    keep_absent,
    keep_members,
    keyed_merge,
    negative_score,
    recode,
    symmetric_difference,
    union_all,
)
from signalweave.operators.once import computed_once
from signalweave.operators.ranking import id_batches, keep_first, most_recent
from signalweave.operators.tagging import explode_tags
from signalweave.plans.collection import first_pages
from signalweave.sources.writers import without_result


def country_recode(spark: SparkSession, folder: str) -> DataFrame:
    """Even nations are mapped to a region name; mapped values are kept, then counted."""
    nations = table(spark, folder, "nation")
    dimension = nations.filter("n_nationkey % 2 = 0").select(
        "n_name", F.concat(F.lit("REGION_"), F.col("n_regionkey").cast("string")).alias("region")
    )
    users = table(spark, folder, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    named = recode(users.select("c_custkey", F.col("n_name").alias("country")), "country", dimension, "n_name", "region")
    kept = keep_members(named, "country", dimension, "region")
    return kept.groupBy("country").agg(F.count("c_custkey").alias("n"))


def country_recode_all(spark: SparkSession, folder: str) -> DataFrame:
    """The recode alone: unmapped values stay."""
    nations = table(spark, folder, "nation")
    dimension = nations.filter("n_nationkey % 2 = 0").select(
        "n_nationkey", F.concat(F.lit("REGION_"), F.col("n_regionkey").cast("string")).alias("region")
    )
    users = table(spark, folder, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("country"))
    dimension = dimension.withColumn("code", F.col("n_nationkey").cast("string"))
    return recode(users, "country", dimension, "code", "region")


def dedupe_keep_first(spark: SparkSession, folder: str) -> DataFrame:
    """Of documents with the same text the lowest id; texts travel as digests."""
    docs = table(spark, folder, "documents")
    digests = docs.select("doc_id", "lang", "source", F.sha2("text", 256).alias("digest"))
    return keep_first(digests, ["digest"], [F.asc("doc_id")]).drop("digest")


def recent_n_per_user(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("user_id", "event_id", "ts")
    order = [F.desc("ts"), F.desc("event_id")]
    ranked = most_recent(events, ["user_id"], order, 20, spread_by=["event_id"])
    return ranked.select("user_id", "event_id", "rank")


def id_batches_query(spark: SparkSession, folder: str) -> DataFrame:
    batches = id_batches(table(spark, folder, "customer"), "c_custkey", 6)
    return batches.select("batch", F.array_join("ids", ",").alias("ids"))


def posts_users_left_join(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with their customer; a tenth of the orders have no customer key."""
    owner = F.when(F.col("o_orderkey") % 10 != 0, F.col("o_custkey"))
    posts = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), owner.cast("string").alias("Reference_Agency_ID"),
        F.lit("tweet").alias("message_type"),
    )
    users = table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"),
    )
    return join_users(posts, users, "Reference_Agency_ID", "id")


def flatten_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Counters written as Python dicts, some of them None, back to columns."""
    quotes = F.when(F.col("user_id") % 3 == 0, "None").otherwise((F.col("event_id") % 5).cast("string"))
    text = F.concat(
        F.lit("{'reply_count': "), F.get_json_object("props", "$.k"), F.lit(", 'quote_count': "), quotes, F.lit("}")
    )
    events = computed_once(table(spark, folder, "events"), public_metrics=parse_metrics(text))
    return flatten(events.filter(engaged(50)), "public_metrics").select("event_id", "reply_count", "quote_count")


def literal_list_explode(spark: SparkSession, folder: str) -> DataFrame:
    """Lists written as Python literals to one row per entry; empty lists are dropped."""
    text = F.when(F.col("c_acctbal") < 0, "[]").otherwise(
        F.concat(F.lit("['"), F.lower("c_mktsegment"), F.lit("', \"cote d'"), F.lower("c_name"), F.lit('"]'))
    )
    users = table(spark, folder, "customer").select("c_custkey", text.alias("Country"))
    parsed = users.filter(F.col("Country") != "[]").withColumn("tags", parse_list("Country"))
    return explode_tags(parsed.drop("Country"), "tags", "country")


def new_users_anti(spark: SparkSession, folder: str) -> DataFrame:
    """Customers without a large order."""
    done = table(spark, folder, "orders").filter("o_totalprice > 300000")
    return keep_absent(table(spark, folder, "customer"), "c_custkey", done, "o_custkey").select("c_custkey", "c_name")


def users_by_handle(spark: SparkSession, folder: str) -> DataFrame:
    """Customers whose handle is on a list of accounts."""
    accounts = table(spark, folder, "orders").filter("o_totalprice > 400000").select(
        F.format_string("Customer#%09d", "o_custkey").alias("username")
    )
    users = table(spark, folder, "customer").select("c_custkey", "c_name")
    return keep_members(users, "c_name", accounts, "username")


def ids_semi(spark: SparkSession, folder: str) -> DataFrame:
    meta = table(spark, folder, "labels").filter("quality = 1")
    docs = table(spark, folder, "documents").select("doc_id", "lang", "source")
    return keep_members(docs, "doc_id", meta, "doc_id")


def failed_ids(spark: SparkSession, folder: str) -> DataFrame:
    requested = table(spark, folder, "documents").select(F.col("doc_id").alias("id"))
    return without_result(requested, table(spark, folder, "labels").select(F.col("doc_id").alias("id")))


def key_symmetric_diff(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(F.col("doc_id").alias("id"))
    return symmetric_difference(docs, table(spark, folder, "labels").select((F.col("doc_id") * 2).alias("id")))


def _customers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer")


def _suppliers(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "supplier")


def union_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Two sources with different names and scores under one schema."""
    nations = table(spark, folder, "nation").withColumn("code", F.col("n_nationkey").cast("string"))
    a = _customers(spark, folder).select(
        F.col("c_custkey").alias("id"), negative_score("c_acctbal").alias("negative"),
        F.col("c_mktsegment").alias("category"), F.col("c_nationkey").cast("string").alias("country"),
    )
    b = _suppliers(spark, folder).select(
        F.col("s_suppkey").alias("id"), F.lit("SUPPLY").alias("category"),
        negative_score("s_acctbal").alias("negative"), F.col("s_nationkey").cast("string").alias("country"),
    )
    return recode(union_all([a, b]), "country", nations, "code", "n_name")


def union_missing_cols(spark: SparkSession, folder: str) -> DataFrame:
    a = _customers(spark, folder).select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"),
                                         F.col("c_mktsegment").alias("segment"))
    b = _suppliers(spark, folder).select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nation"))
    return fill_counts(union_all([a, b]))


def keyed_merge_query(spark: SparkSession, folder: str) -> DataFrame:
    a = _customers(spark, folder).select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    b = _suppliers(spark, folder).select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return keyed_merge(a, b, "id")


def year_ranges_query(spark: SparkSession, folder: str) -> DataFrame:
    """Orders per yearly half-open range; the year is the join key, so no range join is needed."""
    ranges = year_ranges(spark, 1996, 2001)
    orders = table(spark, folder, "orders").filter(within("o_orderdate", "1996-01-01", "2001-01-01"))
    yearly = orders.groupBy(F.year("o_orderdate").alias("year")).agg(F.count("o_orderkey").alias("n"))
    return ranges.join(yearly, "year", "left").select("range_start", "range_end", F.coalesce("n", F.lit(0)).alias("n"))


def mention_author_filters(spark: SparkSession, folder: str) -> DataFrame:
    """Events as posts: not a repost, from one place or one author, mentioning a user."""
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name")
    users = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    events = table(spark, folder, "events").select(
        "event_id", "user_id",
        F.concat(F.lit("see @user"), (F.col("event_id") % 10).cast("string"), F.lit(", x@user1 "), F.col("event_type")).alias("text"),
        F.when(F.col("event_type") == "error", F.array(F.struct(F.lit("retweeted").alias("type"), F.lit("1").alias("id"))))
        .alias("referenced_tweets"),
    )
    posts = (
        events.filter(not_repost())
        .filter(mentions("text", "user1") | mentions("text", "@USER2"))
        .join(users, events["user_id"] == users["c_custkey"])
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .withColumn("geo", F.struct(F.col("n_name").alias("country_code")))
    )
    return posts.filter(in_place("NATION_3") | (F.col("user_id") == 8)).select("event_id", "user_id")


def global_sum(spark: SparkSession, folder: str) -> DataFrame:
    flag = F.when(F.col("event_type") == "purchase", 1).otherwise(0)
    return table(spark, folder, "events").agg(F.sum(flag).alias("flag_total"), F.count(F.lit(1)).alias("total_count"))


def distinct_values(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("user_id", "event_type").distinct()


def top_accounts(spark: SparkSession, folder: str) -> DataFrame:
    """The first two pages of accounts, largest first."""
    users = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    return first_pages(users, [F.desc("c_acctbal"), F.asc("c_custkey")], pages=2, page_size=25)


def suffix_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Part names, some with an ending, looked up in the list of names."""
    parts = table(spark, folder, "part").select(
        "p_partkey",
        F.concat("p_name", F.element_at(F.array(*map(F.lit, ("", "s", "es", "ing", "able"))),
                                        (F.col("p_partkey") % 5 + 1).cast("int"))).alias("surface"),
    )
    names = table(spark, folder, "part").filter("p_size > 5").select("p_name")
    return strip_lookup(parts, "surface", names, "p_name")


QUERIES = {
    "country_recode": country_recode,
    "country_recode_all": country_recode_all,
    "dedupe_keep_first": dedupe_keep_first,
    "recent_n_per_user": recent_n_per_user,
    "id_batches": id_batches_query,
    "posts_users_left_join": posts_users_left_join,
    "flatten_metrics": flatten_metrics,
    "literal_list_explode": literal_list_explode,
    "new_users_anti": new_users_anti,
    "users_by_handle": users_by_handle,
    "ids_semi": ids_semi,
    "failed_ids": failed_ids,
    "key_symmetric_diff": key_symmetric_diff,
    "union_sources": union_sources,
    "union_missing_cols": union_missing_cols,
    "keyed_merge": keyed_merge_query,
    "year_ranges": year_ranges_query,
    "mention_author_filters": mention_author_filters,
    "global_sum": global_sum,
    "distinct_values": distinct_values,
    "top_accounts": top_accounts,
    "suffix_lookup": suffix_lookup,
}

ORACLE = {
    "country_recode": """SELECT 'REGION_' || n_regionkey AS country, count(c_custkey) AS n
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_nationkey % 2 = 0 GROUP BY 1""",
    "country_recode_all": """SELECT c_custkey,
  CASE WHEN n_nationkey % 2 = 0 THEN 'REGION_' || n_regionkey ELSE CAST(c_nationkey AS VARCHAR) END AS country
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "dedupe_keep_first": """SELECT doc_id, lang, source FROM (
  SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS r FROM documents) WHERE r = 1""",
    "recent_n_per_user": """SELECT user_id, event_id, CAST(r AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events)
WHERE r <= 20""",
    "id_batches": """SELECT batch, string_agg(CAST(c_custkey AS VARCHAR), ',' ORDER BY c_custkey) AS ids FROM (
  SELECT c_custkey, CAST(floor((row_number() OVER (ORDER BY c_custkey) - 1) / 6) AS BIGINT) AS batch FROM customer)
GROUP BY batch""",
    "posts_users_left_join": """SELECT o_orderkey AS id_left, CAST(k AS VARCHAR) AS "Reference_Agency_ID",
  'tweet' AS message_type, CAST(c_custkey AS VARCHAR) AS id_right, c_name AS name, c_mktsegment AS segment
FROM (SELECT *, CASE WHEN o_orderkey % 10 <> 0 THEN o_custkey END AS k FROM orders)
LEFT JOIN customer ON k = c_custkey""",
    "flatten_metrics": """SELECT * FROM (
  SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS reply_count,
         CASE WHEN user_id % 3 <> 0 THEN event_id % 5 END AS quote_count FROM events)
WHERE coalesce(reply_count, 0) + coalesce(quote_count, 0) >= 50""",
    "literal_list_explode": """SELECT c_custkey, unnest([lower(c_mktsegment), 'cote d''' || lower(c_name)]) AS country
FROM customer WHERE c_acctbal >= 0""",
    "new_users_anti": """SELECT c_custkey, c_name FROM customer
WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)""",
    "users_by_handle": """SELECT c_custkey, c_name FROM customer
WHERE c_name IN (SELECT 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') FROM orders WHERE o_totalprice > 400000)""",
    "ids_semi": """SELECT doc_id, lang, source FROM documents
WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)""",
    "failed_ids": "SELECT doc_id AS id FROM documents EXCEPT SELECT doc_id FROM labels",
    "key_symmetric_diff": """(SELECT doc_id AS id FROM documents EXCEPT SELECT doc_id * 2 FROM labels)
UNION (SELECT doc_id * 2 AS id FROM labels EXCEPT SELECT doc_id FROM documents)""",
    "union_sources": """SELECT id, negative, category, n_name AS country FROM (
  SELECT c_custkey AS id, CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS negative, c_mktsegment AS category,
         c_nationkey AS k FROM customer
  UNION ALL
  SELECT s_suppkey, CASE WHEN s_acctbal > 0 THEN 1 ELSE 0 END, 'SUPPLY', s_nationkey FROM supplier)
JOIN nation ON k = n_nationkey""",
    "union_missing_cols": """SELECT c_custkey AS id, c_acctbal AS balance, c_mktsegment AS segment, 0 AS nation FROM customer
UNION ALL SELECT s_suppkey, 0.0, NULL, s_nationkey FROM supplier""",
    "keyed_merge": """SELECT s_suppkey AS id, s_name AS name FROM supplier
UNION ALL SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)""",
    "year_ranges": """SELECT CAST(s AS DATE) AS range_start, CAST(s + INTERVAL 1 YEAR AS DATE) AS range_end, count(o_orderkey) AS n
FROM generate_series(TIMESTAMP '1996-01-01', TIMESTAMP '2000-01-01', INTERVAL 1 YEAR) AS g(s)
LEFT JOIN orders ON o_orderdate >= s AND o_orderdate < s + INTERVAL 1 YEAR GROUP BY ALL""",
    "mention_author_filters": """SELECT event_id, user_id FROM events
JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE event_type <> 'error' AND event_id % 10 IN (1, 2) AND (n_name = 'NATION_3' OR user_id = 8)""",
    "global_sum": """SELECT CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS flag_total,
  count(*) AS total_count FROM events""",
    "distinct_values": "SELECT DISTINCT user_id, event_type FROM events",
    "top_accounts": "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 50",
    "suffix_lookup": """WITH names AS (SELECT DISTINCT p_name FROM part WHERE p_size > 5),
s AS (SELECT p_partkey, p_name || ['', 's', 'es', 'ing', 'able'][p_partkey % 5 + 1] AS surface FROM part),
c AS (SELECT p_partkey, surface, unnest([0, 1, 2, 3]) AS cut FROM s),
m AS (SELECT p_partkey, arg_min(p_name, cut) AS matched_key
      FROM c JOIN names ON p_name = left(surface, length(surface) - cut) GROUP BY ALL)
SELECT p_partkey, surface, matched_key FROM s LEFT JOIN m USING (p_partkey)""",
}
