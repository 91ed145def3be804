"""Conversations: root posts, replies to them and quotes of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalweave.functions.predicates import engaged, is_root
from signalweave.operators.once import explode_once
from signalweave.operators.ranking import MANY_SALTS, SALTS, most_recent

REFERENCES = "array<struct<twitter_type: string, referenced_tweet_id: string>>"


def root_posts(posts: DataFrame, roots_only: bool = True, threshold: int = 1) -> DataFrame:
    """Posts that open a conversation and drew at least `threshold` replies and quotes."""
    out = posts.filter(is_root()) if roots_only else posts
    return out.filter(engaged(threshold)) if threshold > 0 else out


def reply_reference(include_root: bool = False) -> Column:
    """A post answers the root of its conversation; the root itself only with `include_root`."""
    wanted = F.col("conversation_id").isNotNull()
    if not include_root:
        wanted = wanted & (F.col("id") != F.col("conversation_id"))
    return F.when(wanted, F.array(F.struct(F.lit("reply"), F.col("conversation_id"))).cast(REFERENCES))


def quote_references() -> Column:
    """The posts that a post really quotes."""
    quoted = F.filter("referenced_tweets", lambda r: r["type"] == "quoted")
    named = F.transform(quoted, lambda r: F.struct(F.lit("quote"), r["id"]))
    return F.array_distinct(named.cast(REFERENCES))


def _referring(posts: DataFrame, references: Column, roots: DataFrame) -> DataFrame:
    """One row per post and reference to one of the roots, with the reference's two columns.

    A semi-join: only root ids travel, and a conversation with very many posts is on the side
    that Spark splits when a partition is skewed.
    """
    ids = roots.select(F.col("id").alias("_root"))
    rows = explode_once(posts, "_reference", references).select(
        *posts.columns, "_reference.twitter_type", "_reference.referenced_tweet_id"
    )
    return rows.join(ids, rows["referenced_tweet_id"] == ids["_root"], "left_semi")


def replies_to(posts: DataFrame, roots: DataFrame, include_root: bool = False) -> DataFrame:
    """Posts in the roots' conversations."""
    return _referring(posts, reply_reference(include_root), roots)


def quotes_of(posts: DataFrame, roots: DataFrame) -> DataFrame:
    """Posts that quote a root."""
    return _referring(posts, quote_references(), roots)


def replies_and_quotes(
    posts: DataFrame, roots: DataFrame, include_root: bool = False, per_root: int | None = None
) -> DataFrame:
    """Replies and quotes in one pass over the posts and one join with the roots.

    `per_root` keeps that many most recent ones of each type per root.
    """
    none = F.array().cast(REFERENCES)
    references = F.concat(
        F.coalesce(reply_reference(include_root), none), F.coalesce(quote_references(), none)
    )
    both = _referring(posts, references, roots)
    if per_root is None:
        return both
    keys = ["referenced_tweet_id", "twitter_type"]
    order = [F.desc("created_at"), F.desc("id")]
    # Always in parts: the rows already lie by root, and without the parts Spark would rank a
    # very large conversation where it lies, in one task.
    salts = MANY_SALTS if per_root > SALTS else SALTS
    return most_recent(both, keys, order, per_root, spread_by=["id"], salts=salts).drop("rank")
