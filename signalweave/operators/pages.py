"""Order of result pages that name the page after them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalweave.session import cut_lineage

FIRST = ""


def chain_pages(pages: DataFrame, by: Sequence[str], token: str = "token", next_token: str = "next_token") -> DataFrame:
    """One row per page of every request `by`: its `token`, `next_token`, `copies`, `segment`, `position` and `status`.

    A page is known by its request and the token it was fetched with; a first page has none (NULL, returned as "").
    Repeated pages become one, of which `copies` counts the rows and the greatest `next_token` stays.  `segment` is the
    token of the page that a chain begins with and `position` counts from 0 there.  `status` is `whole` for pages of
    a chain that begins with a first page, `cut` for those after a gap, and `loop` for those in or behind pages that follow each
    other in a circle, which have no beginning (`segment` and `position` are NULL).  `missing_next` marks a page whose following page is absent.

    The distance to the beginning is found by doubling: in each round a page points to where the page that it points to
    points, so that a chain of a million pages takes twenty rounds, each a join on the token.
    """
    keys = [pages[c].alias(f"_k{i}") for i, c in enumerate(by)]
    names = [f"_k{i}" for i in range(len(by))]
    rows = pages.select(*keys, F.coalesce(pages[token], F.lit(FIRST)).alias("token"), pages[next_token].alias("next_token"))
    # Requests are compared with NULL equal to NULL.
    request = F.to_json(F.struct(*names), {"ignoreNullFields": "false"})
    rows = rows.withColumn("_r", request)
    kept = rows.groupBy("_r", "token").agg(
        F.max("next_token").alias("next_token"), F.count(F.lit(1)).alias("copies"), *[F.first(n).alias(n) for n in names]
    )
    kept = cut_lineage(kept)
    # Of several pages that name one page the one of the least token counts.
    before = kept.filter("next_token IS NOT NULL").groupBy("_r", "next_token").agg(F.min("token").alias("to"))
    before = before.select("_r", F.col("next_token").alias("token"), "to")
    # Nothing stands before a first page, whatever page names it.
    links = kept.select("_r", "token").join(before, ["_r", "token"], "left")
    first = (F.col("token") == FIRST) | F.col("to").isNull()
    links = cut_lineage(
        links.select("_r", "token", F.when(first, F.col("token")).otherwise(F.col("to")).alias("to"), F.when(first, 0).otherwise(1).cast("long").alias("far"))
    )
    reach, total = 1, links.count()
    while reach <= 2 * total:
        # Pages whose pointer stands at the beginning of a chain are done; the others go on from where it stands.
        other = links.select("_r", F.col("token").alias("to"), F.col("to").alias("_to"), F.col("far").alias("_far"))
        moved = links.join(other, ["_r", "to"]).select("_r", "token", F.col("_to").alias("to"), (F.col("far") + F.col("_far")).alias("far"))
        moved = cut_lineage(moved)
        reach *= 2
        changed = moved.select("_r", "token", "to").exceptAll(links.select("_r", "token", "to")).limit(1).count()
        links = moved
        if not changed:
            break
    starts = kept.select("_r", "token").join(before, ["_r", "token"], "left").filter(first).select("_r", F.col("token").alias("to"), F.lit(True).alias("start"))
    placed = links.join(starts, ["_r", "to"], "left")
    present = kept.select("_r", F.col("token").alias("next_token"), F.lit(True).alias("there"))
    whole = F.coalesce("start", F.lit(False))
    joined = kept.join(placed, ["_r", "token"]).join(present, ["_r", "next_token"], "left")
    return joined.select(
        *[F.col(n).alias(c) for n, c in zip(names, by)], "token", "next_token", "copies",
        F.when(whole, F.col("to")).alias("segment"), F.when(whole, F.col("far")).alias("position"),
        F.when(~whole, "loop").when(F.col("to") == FIRST, "whole").otherwise("cut").alias("status"),
        (F.col("next_token").isNotNull() & F.col("there").isNull()).alias("missing_next"),
    )
