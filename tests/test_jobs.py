"""End-to-end jobs and streams on small files."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from signalweave.functions.predicates import term
from signalweave.plans.collection import select_posts
from signalweave.plans.policies import policy_series, write_policy_series
from signalweave.plans.sentiment import (
    clean_posts, cross_country_quartiles, merge_tagged_and_geo, read_sentiment_posts, sentiment_series, tag_posts,
)
from signalweave.plans.user_posts import account_indicators, tweets_and_mentions
from signalweave.sources import schemas as S
from signalweave.sources.dictionaries import rules_of
from signalweave.sources.readers import read_csv
from signalweave.streaming.monthly import (
    distinct_within, read_arriving, run_append, run_counts, streaming_counts,
)

GAZETTEER = {"iran": ["iran"], "china": ["china", "chinese"]}
MAP = "﻿2_Code,Identified_Country_Name,3_Code,Country_Code,IMF_Country_Name\nIR,iran,IRN,429,Iran\nCN,china,CHN,924,China\n"


def post_files(folder):
    header = "created_at,lang,id,text_processed,negative,netural,positive,label,Country\n"
    folder.mkdir()
    (folder / "market_2020.csv").write_text(
        header
        + "2020-01-05T00:00:00Z,en,1,tax in iran,0,0,1,0,\n"
        + "2020-01-04T00:00:00Z,en,1,tax in iran and china,0,0,1,0,\n"
        + "2020-01-06T00:00:00Z,en,2,chinese tax,0,0,1,2,\n"
        + "2020-02-06T00:00:00Z,en,3,nowhere,0,0,1,2,\n",
        encoding="utf-8",
    )
    (folder / "nonmarket_2020.csv").write_text(header + "2020-01-05T00:00:00Z,en,1,iran,0,0,1,1,\n", encoding="utf-8")
    return str(folder)


def test_sentiment_job(spark, tmp_path):
    posts = tag_posts(read_sentiment_posts(spark, post_files(tmp_path / "in")), GAZETTEER)
    rows = clean_posts(posts)
    assert {(r.id, r.category, r.country, r.negative, r.time) for r in rows.collect()} == {
        ("1", "market", "iran", 1, dt.date(2020, 1, 4)), ("1", "market", "china", 1, dt.date(2020, 1, 4)),
        ("2", "market", "china", 0, dt.date(2020, 1, 6)), ("1", "nonmarket", "iran", 0, dt.date(2020, 1, 5)),
    }
    series = sentiment_series(rows)
    got = {(r.country, r.category): (r["neutral-positive"], r.negative, r.negative_share) for r in series.collect()}
    assert got == {("iran", "market"): (0, 1, 1.0), ("china", "market"): (1, 1, 0.5), ("iran", "nonmarket"): (1, 0, 0.0)}
    (tmp_path / "map.csv").write_text(MAP, encoding="utf-8")
    mapped = cross_country_quartiles(series, read_csv(spark, str(tmp_path / "map.csv"), S.COUNTRY_MAP))
    market = {r.country: (r.percentile_25, r.percentile_75) for r in mapped.filter("category = 'market'").collect()}
    assert market == {"Iran": (0.625, 0.875), "China": (0.625, 0.875)}


def test_labels_written_as_text(spark):
    rows = [("2020-01-01", "t", "1", 0, "m", "['iran', 'china']"), ("2020-01-01", "t", "2", 0, "m", "[]"), ("2020-01-01", "t", "3", 0, "m", None)]
    posts = spark.createDataFrame(rows, "created_at STRING, text_processed STRING, id STRING, label INT, category STRING, Country STRING")
    assert sorted(r.country for r in clean_posts(posts).collect()) == ["china", "iran"]


def test_tagged_and_geo_union(spark, tmp_path):
    (tmp_path / "map.csv").write_text(MAP, encoding="utf-8")
    (tmp_path / "t.csv").write_text("created_at,text_processed,id,label,Market,Country\n2020-01-01,x,1,0,market,\"['iran', 'mars']\"\n2020-01-01,y,2,1,market,[]\n", encoding="utf-8")
    (tmp_path / "g.csv").write_text("created_at,new_text,id,negative,category,country\n2020-02-03,z,3,0.4,nonmarket,CN\n", encoding="utf-8")
    country_map = read_csv(spark, str(tmp_path / "map.csv"), S.COUNTRY_MAP)
    rows = merge_tagged_and_geo(spark, str(tmp_path / "t.csv"), str(tmp_path / "g.csv"), country_map)
    assert {(r.id, r.country, r.negative, r.category, r.time_month) for r in rows.collect()} == {
        ("1", "Iran", 1, "market", dt.date(2020, 1, 1)), ("3", "China", 1, "nonmarket", dt.date(2020, 2, 1)),
    }


def test_policy_job(spark, tmp_path):
    book = {"tax": rules_of([("tax", [], ["levy"])]), "levy": rules_of([("levy", [], [])])}
    month = dt.date(2020, 1, 1)
    rows = [("1", "iran", 1, month, "a tax"), ("2", "iran", 0, month, "tax levy"), ("3", "iran", 0, month, "tax"), ("4", "iran", 0, month, "")]
    posts = spark.createDataFrame(rows, "id STRING, country STRING, negative INT, time_month DATE, text_processed STRING")
    series = policy_series(posts, book)
    assert {(r.policy, r.negative, r["neutral-positive"]) for r in series.collect()} == {("tax", 1, 1), ("levy", 0, 1)}
    write_policy_series(series, str(tmp_path / "out"))
    assert sorted(p.name for p in (tmp_path / "out").glob("policy=*")) == ["policy=levy", "policy=tax"]


def test_account_indicators(spark):
    tweets = spark.createDataFrame(
        [("1", "u", "2020-01-02T", "en", "Clima y ley", (1, 2, 3, 4, 5)), ("2", None, "2020-02-02T", "es", "nada", None)],
        "id STRING, author_id STRING, created_at STRING, lang STRING, text STRING, "
        "public_metrics STRUCT<retweet_count: BIGINT, reply_count: BIGINT, like_count: BIGINT, quote_count: BIGINT, impression_count: BIGINT>",
    )
    mentions = tweets.filter("id = '1'").withColumn("mentioned_user_id", F.lit("v"))
    users = spark.createDataFrame([("u", "ann", "Ann", "2010", 7), ("v", "vic", "Vic", "2011", 9)], "id STRING, username STRING, name STRING, created_at STRING, followers_count INT")
    messages = tweets_and_mentions(tweets, mentions)
    out = account_indicators(messages, users, {"clima": ["clima"], "ley": ["ley"]})
    rows = {(r.message_type, r.name): (r.followers_count, r.like_count, r.clima_count, r.ley_dummy, r.all_dummy, r.time_month) for r in out.collect()}
    january = dt.date(2020, 1, 1)
    assert rows == {
        ("tweet", "Ann"): (7, 3, 1, 1, 1, january), ("mention", "Vic"): (9, 3, 1, 1, 1, january),
        ("tweet", None): (None, None, 0, 0, 0, dt.date(2020, 2, 1)),
    }


def test_selection_of_landed_posts(spark):
    posts = spark.createDataFrame(
        [("1", "tariffs on carbon", "2020-05-01", ("AR",), None), ("2", "tariffs on carbon", "2021-01-01", ("AR",), None),
         ("3", "carbon", "2020-05-01", ("AR",), None), ("4", "tariffs carbon", "2020-05-01", ("BR",), None),
         ("5", "tariffs carbon", "2020-05-01", ("AR",), [("retweeted", "1")])],
        "id STRING, text STRING, created_at STRING, geo STRUCT<country_code: STRING>, referenced_tweets ARRAY<STRUCT<type: STRING, id: STRING>>",
    )
    queries = {"market": [term("text", "tariffs") & term("text", "carbon")], "any": [term("text", "carbon"), term("text", "tariffs")]}
    got = select_posts(posts, queries, "2020-01-01", "2021-01-01", country="AR")
    assert {(r.id, r.group) for r in got.collect()} == {("1", "market"), ("1", "any"), ("3", "any")}
    assert "4" in {r.id for r in select_posts(posts, queries, "2020-01-01", "2021-01-01").collect()}


def test_stream_counts_grow_with_new_files(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "id STRING, k STRING, ts TIMESTAMP_NTZ"
    first = [("1", "a", dt.datetime(2020, 1, 1)), ("2", "a", dt.datetime(2020, 1, 1)), ("3", None, dt.datetime(2020, 1, 1))]
    spark.createDataFrame(first, schema).write.parquet(source)
    for _ in range(2):
        run_counts(streaming_counts(read_arriving(spark, source, schema), ["k"]), target, state)
        assert {(r.k, r.id_count) for r in spark.read.parquet(target).collect()} == {("a", 2)}
    spark.createDataFrame([("4", "a", dt.datetime(2020, 1, 2)), ("5", "b", dt.datetime(2020, 1, 2))], schema).write.mode("append").parquet(source)
    run_counts(streaming_counts(read_arriving(spark, source, schema), ["k"]), target, state)
    assert {(r.k, r.id_count) for r in spark.read.parquet(target).collect()} == {("a", 3), ("b", 1)}


def test_stream_drops_copies_across_files(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = "id STRING, ts TIMESTAMP_NTZ"
    spark.createDataFrame([("1", dt.datetime(2020, 1, 1)), ("1", dt.datetime(2020, 1, 1))], schema).write.parquet(source)
    run_append(distinct_within(read_arriving(spark, source, schema), ["id"], "ts"), target, state)
    spark.createDataFrame([("1", dt.datetime(2020, 1, 1)), ("2", dt.datetime(2020, 1, 1))], schema).write.mode("append").parquet(source)
    run_append(distinct_within(read_arriving(spark, source, schema), ["id"], "ts"), target, state)
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == ["1", "2"]
