"""Series operators against pandas."""

from __future__ import annotations

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from signalweave.operators.series import (
    counts_with_share, merge_counts, monthly_counts, pivot_share, quartiles, trailing_stats,
)

POSTS = "id STRING, time_month DATE, country STRING, category STRING, negative INT"


def month(i: int) -> dt.date:
    return dt.date(2019 + i // 12, i % 12 + 1, 1)


@pytest.fixture(scope="module")
def posts(spark):
    rng = random.Random(7)
    rows = [
        (str(n), month(rng.choice([m for m in range(30) if m % 7])), rng.choice("ABC"), rng.choice(["m", "n"]), rng.randint(0, 1))
        for n in range(3000)
    ]
    rows += [("x1", None, "A", "m", 1), (None, month(1), "A", "m", 1), ("x2", month(1), None, "m", 0)]
    return spark.createDataFrame(rows, POSTS)


@pytest.fixture(scope="module")
def expected(posts):
    """The same steps in pandas."""
    df = posts.toPandas()
    counts = df.groupby(["time_month", "country", "category", "negative"])["id"].count().reset_index(name="id_count")
    wide = counts.pivot(index=["country", "category", "time_month"], columns="negative", values="id_count")
    wide = wide.fillna(0).reset_index().rename(columns={0: "other", 1: "neg"})
    wide["share"] = wide["neg"] / (wide["neg"] + wide["other"])
    groups = wide.groupby(["country", "category"])["share"]
    wide["ma"] = groups.transform(lambda x: x.rolling(12, 1).mean())
    wide["sd"] = groups.transform(lambda x: x.rolling(12, 1).std())
    for q in (25, 50, 75):
        wide[f"q{q}"] = wide.groupby(["category", "time_month"])["share"].transform(lambda x, q=q: x.quantile(q / 100))
    return wide


def test_series_equals_pandas(posts, expected):
    ours = quartiles(trailing_stats(counts_with_share(posts))).toPandas()
    both = ours.merge(expected, on=["country", "category", "time_month"], suffixes=("", "_p"))
    assert len(both) == len(ours) == len(expected)
    pairs = {"negative": "neg", "neutral-positive": "other", "negative_share": "share", "12m_ma": "ma", "12m_sd": "sd",
             "percentile_25": "q25", "percentile_50": "q50", "percentile_75": "q75"}
    for a, b in pairs.items():
        pd.testing.assert_series_equal(both[a].astype(float), both[b].astype(float), check_names=False, rtol=1e-9, atol=1e-12)
    score = ((both["share"] - both["ma"]) / both["sd"]).round(9) > 1
    assert (both["up_over_1sd"] == score).all()
    assert ours["negative_share"].between(0, 1).all()


def test_long_form_and_partials_agree(posts):
    direct = monthly_counts(posts)
    partial = monthly_counts(posts.withColumn("part", F.length("id")), ("part", "time_month", "country", "category", "negative"))
    assert sorted(direct.collect()) == sorted(merge_counts(partial).collect())
    assert sorted(pivot_share(direct).collect()) == sorted(counts_with_share(posts).collect())


def series(spark, values, months=None):
    rows = [("A", "m", month(m), v) for m, v in zip(months or range(len(values)), values)]
    df = spark.createDataFrame(rows, "country STRING, category STRING, time_month DATE, negative_share DOUBLE")
    return trailing_stats(df).orderBy("time_month").collect()


def test_single_month(spark):
    (row,) = series(spark, [0.4])
    assert (row["12m_ma"], row["12m_sd"], row.up_over_1sd) == (0.4, None, False)


def test_constant_share_has_no_outlier(spark):
    assert [(r["12m_sd"], r.up_over_1sd) for r in series(spark, [0.5] * 3)][1:] == [(0.0, False)] * 2


def test_frame_counts_rows_not_months(spark):
    rows = series(spark, [1.0] + [0.0] * 12, months=[0, *range(5, 17)])
    assert rows[11]["12m_ma"] == pytest.approx(1 / 12) and rows[12]["12m_ma"] == 0.0


def test_score_of_exactly_one_is_no_outlier(spark):
    """0, 0, 1 after 0.5: the last score is exactly one in exact arithmetic."""
    rows = series(spark, [0.1, 0.1, 0.4])
    score = (rows[2].negative_share - rows[2]["12m_ma"]) / rows[2]["12m_sd"]
    assert score == pytest.approx(2 / 3**0.5) and rows[2].up_over_1sd
    low, high = 0.3, 0.7
    exact = series(spark, [low, high, high, low, (low + high) / 2 + ((high - low) / 2) * 1.0])
    assert exact[-1].up_over_1sd == (round((exact[-1].negative_share - exact[-1]["12m_ma"]) / exact[-1]["12m_sd"], 9) > 1)


def test_only_one_label_present(spark):
    df = spark.createDataFrame([("1", month(0), "A", "m", 1)], POSTS)
    (row,) = pivot_share(monthly_counts(df)).collect()
    assert (row["neutral-positive"], row.negative, row.negative_share) == (0, 1, 1.0)


def test_quartiles_interpolate(spark):
    df = spark.createDataFrame([("m", month(0), v) for v in (0.0, 0.1, 0.4, 1.0)], "category STRING, time_month DATE, negative_share DOUBLE")
    row = quartiles(df).first()
    assert [round(row[f"percentile_{q}"], 9) for q in (25, 50, 75)] == [0.075, 0.25, 0.55]


def test_grouping_keys_are_a_parameter(posts):
    out = trailing_stats(counts_with_share(posts, keys=("country", "time_month")), group_keys=("country",))
    assert "category" not in out.columns and out.count() == out.select("country", "time_month").distinct().count()
