"""Monthly series per policy instrument."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalweave.operators.once import explode_once
from signalweave.operators.rules import add_policies
from signalweave.operators.series import counts_with_share, trailing_stats
from signalweave.sources.dictionaries import Rule
from signalweave.sources.writers import write_table


def policy_series(
    posts: DataFrame, book: Mapping[str, Sequence[Rule]], text: str = "text_processed"
) -> DataFrame:
    """All policies in one job: tag, one row per policy, then the series per policy and country.

    Needs the columns `id`, `country`, `negative`, `time_month` and the text, which is dropped
    as soon as the policies are known.
    """
    tagged = add_policies(posts, book, text).select("id", "country", "negative", "time_month", "policies")
    tagged = explode_once(tagged, "policy", F.col("policies")).drop("policies")
    wide = counts_with_share(tagged, keys=("policy", "country", "time_month"))
    return trailing_stats(wide, group_keys=("policy", "country"))


def write_policy_series(series: DataFrame, path: str) -> None:
    """One folder per policy."""
    write_table(series, path, partition_by=["policy"])
