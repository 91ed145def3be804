"""Selection of posts on landed tables, by the conditions a search service would apply."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalweave.functions.predicates import any_of, in_place, not_repost
from signalweave.functions.temporal import within
from signalweave.operators.once import explode_once


def first_pages(posts: DataFrame, order: Sequence[Column], pages: int, page_size: int = 100) -> DataFrame:
    """The first `pages` pages of a result in the given, total order."""
    return posts.orderBy(*order).limit(pages * page_size)


def select_posts(
    posts: DataFrame,
    queries: Mapping[str, Sequence[Column]],
    start: str,
    end: str,
    country: str | None = None,
    time: str = "created_at",
) -> DataFrame:
    """One row per post and group whose queries it meets, in the range [start, end).

    Time, place and repost tests come first; they are cheap and reach the scan where they can.
    """
    base = posts.filter(within(time, start, end)).filter(not_repost())
    if country:
        base = base.filter(in_place(country))
    groups = F.array_compact(F.array(*[F.when(any_of(*qs), F.lit(g)) for g, qs in queries.items()]))
    return explode_once(base, "group", groups)
