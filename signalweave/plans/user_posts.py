"""Posts collected by account: theme filter, and keyword indicators joined with account data."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalweave.functions.temporal import to_day, to_month
from signalweave.operators.enrich import flatten, join_users, union_all
from signalweave.operators.tagging import add_multi_group, group_counts
from signalweave.operators.themes import add_hits, add_theme_tags, long_enough
from signalweave.sources.dictionaries import AndKeys

SIMPLE_COLUMNS = (
    "time", "time_month", "name", "Reference_Agency_ID", "followers_count", "lang", "message_type",
    "retweet_count", "reply_count", "like_count", "quote_count", "impression_count", "text",
)


def theme_posts(
    posts: DataFrame, keys: AndKeys, themes: Sequence[str] = ("Climate_Keys", "Policy_Keys")
) -> DataFrame:
    """Posts that hit every theme, with hits and tags."""
    searched = add_hits(posts.filter(long_enough()), keys)
    return add_theme_tags(searched, keys, themes).filter(F.col("keep_tag") > 0)


def tweets_and_mentions(tweets: DataFrame, mentions: DataFrame | None = None) -> DataFrame:
    """Own posts and mentions under one account key."""
    own = tweets.withColumns(
        {"message_type": F.lit("tweet"), "Reference_Agency_ID": F.col("author_id").cast("string")}
    )
    if mentions is None:
        return own
    other = mentions.withColumn("message_type", F.lit("mention")).withColumnRenamed(
        "mentioned_user_id", "Reference_Agency_ID"
    )
    return union_all([own, other])


def account_indicators(
    messages: DataFrame, users: DataFrame, groups: Mapping[str, Iterable[str]]
) -> DataFrame:
    """Messages with account data, flat metrics, keyword counts, dummies and `all_dummy`."""
    info = users.select("username", "created_at", "name", "followers_count", F.col("id").cast("string"))
    joined = join_users(messages, info, "Reference_Agency_ID", "id")
    joined = joined.withColumnRenamed("created_at_left", "created_at")
    joined = joined.withColumn("time", to_day("created_at")).withColumn("time_month", to_month("time"))
    simple = flatten(joined, "public_metrics").select(*SIMPLE_COLUMNS)
    return add_multi_group(group_counts(simple, groups), list(groups))
