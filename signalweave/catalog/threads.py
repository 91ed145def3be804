"""Conversations as threads of posts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalweave.catalog.tables import table
from signalweave.functions.predicates import is_root
from signalweave.operators.threads import replies_and_quotes, root_posts


def root_name(conversation: Column) -> Column:
    return F.concat(conversation.cast("string"), F.lit("-0"))


def thread_posts(turns: DataFrame) -> DataFrame:
    """Turns as posts: turn 0 is the root, every third turn quotes the previous conversation's root."""
    quotes = (F.col("turn") > 0) & (F.col("turn") % 3 == 0)
    quoted = F.struct(F.lit("quoted").alias("type"), root_name(F.col("conv_id") - 1).alias("id"))
    return turns.select(
        "conv_id",
        F.concat_ws("-", "conv_id", "turn").alias("id"),
        root_name(F.col("conv_id")).alias("conversation_id"),
        F.col("role").alias("author_id"),
        F.format_string("%06d", "turn").alias("created_at"),
        F.when(quotes, F.array(quoted)).alias("referenced_tweets"),
    )


def threads_and_roots(spark: SparkSession, folder: str, threshold: int) -> tuple[DataFrame, DataFrame]:
    """All posts, and the roots with their reply counts.

    Replies are counted by conversation and joined to the roots only, one row per conversation.
    """
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role")
    posts = thread_posts(turns)
    sizes = turns.groupBy("conv_id").agg((F.count(F.lit(1)) - 1).alias("reply_count"))
    metrics = F.struct("reply_count", F.lit(None).cast("bigint").alias("quote_count"))
    roots = posts.filter(is_root()).join(sizes, "conv_id").withColumn("public_metrics", metrics)
    return posts.drop("conv_id"), root_posts(roots, threshold=threshold)


def conversation_roots(spark: SparkSession, folder: str) -> DataFrame:
    _, roots = threads_and_roots(spark, folder, 3)
    return roots.select("id", "author_id", "public_metrics.reply_count")


def replies_and_quotes_query(spark: SparkSession, folder: str) -> DataFrame:
    found = replies_and_quotes(*threads_and_roots(spark, folder, 3))
    return found.select("id", "twitter_type", "referenced_tweet_id")


def recent_replies(spark: SparkSession, folder: str) -> DataFrame:
    """At most the two latest replies and quotes of each root."""
    found = replies_and_quotes(*threads_and_roots(spark, folder, 3), per_root=2)
    return found.select("id", "twitter_type", "referenced_tweet_id")


QUERIES = {
    "conversation_roots": conversation_roots,
    "replies_and_quotes": replies_and_quotes_query,
    "recent_replies": recent_replies,
}

_POSTS_SQL = """posts AS (
  SELECT conv_id || '-' || turn AS id, conv_id || '-0' AS conversation_id, role AS author_id, turn,
         count(*) OVER (PARTITION BY conv_id) - 1 AS replies,
         CASE WHEN turn > 0 AND turn % 3 = 0 THEN (conv_id - 1) || '-0' END AS quoted
  FROM conversations),
roots AS (SELECT * FROM posts WHERE id = conversation_id AND replies >= 3),
found AS (
  SELECT p.id, 'reply' AS twitter_type, p.conversation_id AS referenced_tweet_id, p.turn
  FROM posts p JOIN roots r ON p.conversation_id = r.id WHERE p.id <> r.id
  UNION ALL
  SELECT p.id, 'quote', p.quoted, p.turn FROM posts p JOIN roots r ON p.quoted = r.id)"""

ORACLE = {
    "conversation_roots": f"WITH {_POSTS_SQL} SELECT id, author_id, replies AS reply_count FROM roots",
    "replies_and_quotes": f"WITH {_POSTS_SQL} SELECT id, twitter_type, referenced_tweet_id FROM found",
    "recent_replies": f"""WITH {_POSTS_SQL}
SELECT id, twitter_type, referenced_tweet_id FROM (
  SELECT *, row_number() OVER (PARTITION BY referenced_tweet_id, twitter_type ORDER BY turn DESC, id DESC) AS r
  FROM found) WHERE r <= 2""",
}
