"""Monthly counts, shares, trailing statistics and cross-group quartiles."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from signalweave.operators.ranking import numbered

COUNT_KEYS = ("time_month", "country", "category", "negative")
SERIES_KEYS = ("country", "category")
OTHER = "neutral-positive"
TRAILING_ROWS = 12


def _quoted(name: str) -> Column:
    return F.col(f"`{name}`")


def with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose grouping keys are all present: a row without a key belongs to no group."""
    return df.filter(reduce(lambda a, b: a & b, [_quoted(k).isNotNull() for k in keys]))


def monthly_counts(
    posts: DataFrame, keys: Sequence[str] = COUNT_KEYS, id_col: str = "id"
) -> DataFrame:
    """Number of ids per key combination.  Spark counts before the shuffle, so no key is hot."""
    return with_keys(posts, keys).groupBy(*keys).agg(F.count(id_col).alias("id_count"))


def merge_counts(partials: DataFrame, keys: Sequence[str] = COUNT_KEYS) -> DataFrame:
    """Final counts from stored partial counts (per file, per year)."""
    return with_keys(partials, keys).groupBy(*keys).agg(F.sum("id_count").alias("id_count"))


def pivot_share(counts: DataFrame, keys: Sequence[str] = (*SERIES_KEYS, "time_month")) -> DataFrame:
    """Counts by label to one row per series and month with both labels and the negative share.

    The two labels are named rather than discovered: no extra pass, and a label that is absent
    from the data counts 0.
    """

    def total(label: int) -> Column:
        return F.coalesce(F.sum(F.when(F.col("negative") == label, F.col("id_count"))), F.lit(0))

    wide = with_keys(counts, keys).groupBy(*keys).agg(total(0).alias(OTHER), total(1).alias("negative"))
    return add_share(wide)


def counts_with_share(
    posts: DataFrame, keys: Sequence[str] = (*SERIES_KEYS, "time_month"), id_col: str = "id"
) -> DataFrame:
    """`monthly_counts` and `pivot_share` in one aggregation, for when the long form is not needed."""

    def total(label: int) -> Column:
        return F.count_if((F.col("negative") == label) & F.col(id_col).isNotNull())

    wide = (
        with_keys(posts, (*keys, "negative"))
        .groupBy(*keys)
        .agg(total(0).alias(OTHER), total(1).alias("negative"))
    )
    return add_share(wide)


def add_share(wide: DataFrame) -> DataFrame:
    share = F.try_divide(F.col("negative"), F.col("negative") + _quoted(OTHER))
    return wide.withColumn("negative_share", share)


def trailing_stats(
    wide: DataFrame,
    group_keys: Sequence[str] = SERIES_KEYS,
    order: str = "time_month",
    value: str = "negative_share",
    rows: int = TRAILING_ROWS,
) -> DataFrame:
    """Trailing mean, sample deviation and the flag "more than one deviation above the mean".

    The frame is the last `rows` rows of the series, whether or not months are missing.  The
    score is rounded to 9 digits before the comparison, since it is exactly 1 in real series
    and must not flip with the order of a floating-point sum.
    """
    frame = W.partitionBy(*group_keys).orderBy(order).rowsBetween(-(rows - 1), 0)
    mean, deviation = f"{rows}m_ma", f"{rows}m_sd"
    score = F.try_divide(F.col(value) - _quoted(mean), _quoted(deviation))
    return (
        wide.withColumn(mean, F.avg(value).over(frame))
        .withColumn(deviation, F.stddev_samp(value).over(frame))
        .withColumn("up_over_1sd", F.coalesce(F.round(score, 9) > 1, F.lit(False)))
    )


def quartiles(
    series: DataFrame,
    keys: Sequence[str] = ("category", "time_month"),
    value: str = "negative_share",
    quantiles: Sequence[float] = (0.25, 0.5, 0.75),
) -> DataFrame:
    """Exact quantiles across groups (linear interpolation) added to every row.

    Input is one row per group and month, so a window holds as many rows as there are groups.
    """
    across = W.partitionBy(*keys)
    # One percentile call collects the values once for all quantiles.
    picked = series.withColumn("_q", F.percentile(value, F.array(*map(F.lit, quantiles))).over(across))
    for place, q in enumerate(quantiles):
        picked = picked.withColumn(f"percentile_{round(q * 100)}", F.col("_q")[place])
    return picked.drop("_q")


def range_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probabilities: Sequence[float] = (0.25, 0.5, 0.75)
) -> DataFrame:
    """The keys and `n`, `q<percent>` of each group: exact, by linear interpolation, for groups of any size.

    All rows are put into the order of keys and value by ranges, and the rows at the wanted places are looked up, so
    that no task holds a group.  Rows without a value or a key do not count; a NaN is the greatest value.
    """
    names = [f"_g{i}" for i in range(len(keys))]
    rows = with_keys(df, keys).filter(_quoted(value).isNotNull())
    rows = rows.select(*[_quoted(k).alias(n) for k, n in zip(keys, names)], _quoted(value).cast("double").alias("_value"))
    placed = numbered(rows, [*names, "_value"])
    groups = placed.groupBy(*names).agg(F.min("position").alias("_begin"), F.count(F.lit(1)).alias("n"))
    at = [F.lit(p) * (F.col("n") - 1) for p in probabilities]
    ends = F.array(*[
        F.struct(F.lit(i).alias("_i"), (F.col("_begin") + edge(x).cast("bigint")).alias("position"), (x - F.floor(x)).alias("_share"), F.lit(high).alias("_high"))
        for i, x in enumerate(at)
        for high, edge in ((False, F.floor), (True, F.ceil))
    ])
    wanted = groups.select(*names, "n", F.explode(ends).alias("_e")).select(*names, "n", "_e.*")
    found = wanted.join(placed.select("position", "_value"), "position")
    part = F.when(F.col("_share") == 0, F.when(F.col("_high"), 0.0).otherwise(F.col("_value"))).otherwise(
        F.col("_value") * F.when(F.col("_high"), F.col("_share")).otherwise(1 - F.col("_share"))
    )
    quantiles = [F.sum(F.when(F.col("_i") == i, part)).alias(f"q{round(100 * p):02d}") for i, p in enumerate(probabilities)]
    answer = found.groupBy(*names, "n").agg(*quantiles)
    return answer.select(*[F.col(n).alias(k) for k, n in zip(keys, names)], "n", *[f"q{round(100 * p):02d}" for p in probabilities])
