"""Ranking, joins, set operations and threads on small tables."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from signalweave.operators import enrich as E
from signalweave.operators.once import computed_once, explode_once
from signalweave.operators.ranking import id_batches, keep_first, most_recent, numbered
from signalweave.operators.threads import quotes_of, replies_and_quotes, replies_to, root_posts


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_first_is_the_earliest(spark):
    rows = [("m", "1", "2020-02", "b"), ("m", "1", "2020-01", "a"), ("n", "1", "2020-03", "c"), ("m", "2", "2020-01", "d")]
    df = spark.createDataFrame(rows, "category STRING, id STRING, created_at STRING, v STRING")
    kept = keep_first(df, ["category", "id"], [F.asc("created_at"), F.asc("v")])
    assert plan(kept).count("WindowGroupLimit") == 2
    assert {r.v for r in kept.collect()} == {"a", "c", "d"}


def test_most_recent_with_a_dominant_key(spark):
    rng = random.Random(3)
    rows = [(0 if rng.random() < 0.4 else rng.randint(1, 9), i, rng.randint(0, 50)) for i in range(2000)]
    df = spark.createDataFrame(rows, "k INT, id INT, ts INT")
    order = [F.desc("ts"), F.desc("id")]
    expected = set()
    for k in range(10):
        own = sorted(((ts, i) for kk, i, ts in rows if kk == k), reverse=True)[:25]
        expected |= {(k, i, rank + 1) for rank, (_, i) in enumerate(own)}
    for salts in (1, 8, None):
        got = most_recent(df, ["k"], order, 25, spread_by=["id"], salts=salts)
        assert {(r.k, r.id, r["rank"]) for r in got.collect()} == expected


def test_parts_are_shuffled_even_where_rows_lie_by_key(spark):
    lying = spark.range(100).selectExpr("id % 3 AS k", "id").repartition(4, "k")
    shuffles = plan(most_recent(lying, ["k"], [F.desc("id")], 100, spread_by=["id"])).count("Exchange")
    assert shuffles == 3


def test_numbering_and_batches(spark):
    ids = [f"{i:05d}" for i in range(100)]
    shuffled = random.Random(1).sample(ids, 100)
    df = spark.createDataFrame([(i,) for i in shuffled], "id STRING").repartition(7)
    places = {r.id: r.position for r in numbered(df, ["id"]).collect()}
    assert places == {i: n for n, i in enumerate(ids)}
    batches = {r.batch: r.ids for r in id_batches(df, "id", 6).collect()}
    assert batches == {b: ids[b * 6 : b * 6 + 6] for b in range(17)}


def test_recode_and_membership(spark):
    df = spark.createDataFrame([("china",), ("atlantis",), (None,)], "country STRING")
    dim = spark.createDataFrame([("china", "China"), (None, "X"), ("iran", "Iran")], "a STRING, b STRING")
    named = E.recode(df, "country", dim, "a", "b")
    assert {r.country for r in named.collect()} == {"China", "atlantis", None}
    assert [r.country for r in E.keep_members(named, "country", dim, "b").collect()] == ["China"]
    assert {r.country for r in E.keep_absent(named, "country", dim, "b").collect()} == {"atlantis", None}


def test_users_join_keeps_posts_without_author(spark):
    posts = spark.createDataFrame([("1", "u", "p1"), ("2", None, "p2"), ("3", "z", "p3")], "id STRING, author STRING, name STRING")
    users = spark.createDataFrame([("u", "Ann"), (None, "?")], "id STRING, name STRING")
    rows = {r.id_left: (r.name_left, r.id_right, r.name_right) for r in E.join_users(posts, users, "author", "id").collect()}
    assert rows == {"1": ("p1", "u", "Ann"), "2": ("p2", None, None), "3": ("p3", None, None)}


def test_columns(spark):
    df = spark.createDataFrame([(1, None, "a", (5, None))], "x INT, y INT, t STRING, m STRUCT<p: INT, q: INT>")
    flat = E.flatten(df, "m")
    assert flat.columns == ["x", "y", "t", "p", "q"]
    row = flat.select(
        E.row_sum(["x", "y", "p"]).alias("s"), E.clip_to_one(F.col("p")).alias("c"), E.dummy("y").alias("d"),
        E.negative_label(F.lit(0)).alias("n0"), E.negative_label("x").alias("n1"), E.negative_score("x").alias("sc"),
    ).first()
    assert tuple(row) == (6, 1, 0, 1, 0, 1)
    assert E.fill_counts(flat.withColumn("t", F.lit(None).cast("string"))).first().asDict() == {"x": 1, "y": 0, "t": None, "p": 5, "q": 0}
    ratio = E.related_ratio(spark.createDataFrame([(1,), (0,)], "d INT"), ["d"]).first()
    assert ratio.d_ratio == 0.5


def test_sets(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b")], "k INT, v STRING")
    b = spark.createDataFrame([(2, "B"), (3, "C")], "k INT, v STRING")
    assert {tuple(r) for r in E.keyed_merge(a, b, "k").collect()} == {(1, "a"), (2, "B"), (3, "C")}
    diff = E.symmetric_difference(a.select("k"), b.select("k"))
    assert {r.k for r in diff.collect()} == {1, 3}
    u = E.union_all([a, b.select("k").withColumn("n", F.lit(7))], fill_zero=True)
    assert {tuple(r) for r in u.collect()} == {(1, "a", 0), (2, "b", 0), (2, None, 7), (3, None, 7)}


def test_costly_columns_appear_once(spark):
    df = spark.createDataFrame([("a b",)], "text STRING")
    found = F.regexp_extract_all("text", F.lit(r"\w"), F.lit(0))
    once = computed_once(df, hits=found).filter(F.size("hits") > 0).withColumn("n", F.size("hits"))
    assert plan(once).count("regexp_extract_all(") == 1 and once.first().n == 2
    rows = explode_once(df, "hit", found)
    assert plan(rows).count("regexp_extract_all(") == 1 and [r.hit for r in rows.collect()] == ["a", "b"]
    assert explode_once(df, "hit", F.array().cast("array<string>")).count() == 0


POSTS = (
    "id STRING, conversation_id STRING, created_at STRING, "
    "public_metrics STRUCT<reply_count: BIGINT, quote_count: BIGINT>, "
    "referenced_tweets ARRAY<STRUCT<type: STRING, id: STRING>>"
)


def test_threads(spark):
    posts = spark.createDataFrame(
        [
            ("1", "1", "a", (1, 0), None),
            ("2", "1", "b", (0, 0), [("replied_to", "1")]),
            ("3", "3", "c", (0, 0), [("quoted", "1")]),
            ("4", "3", "d", (0, 0), [("quoted", "1"), ("quoted", "1"), ("quoted", "3")]),
            ("5", "9", "e", (5, 5), [("retweeted", "1")]),
            ("6", None, "f", None, [("quoted", None)]),
        ],
        POSTS,
    )
    roots = root_posts(posts)
    assert [r.id for r in roots.collect()] == ["1"]
    assert {r.id for r in root_posts(posts, threshold=0).collect()} == {"1", "3"}
    assert {r.id for r in root_posts(posts, roots_only=False).collect()} == {"1", "5"}
    assert [r.id for r in replies_to(posts, roots).collect()] == ["2"]
    assert {r.id for r in replies_to(posts, roots, include_root=True).collect()} == {"1", "2"}
    assert {(r.id, r.referenced_tweet_id) for r in quotes_of(posts, roots).collect()} == {("3", "1"), ("4", "1")}
    both = {(r.id, r.twitter_type) for r in replies_and_quotes(posts, roots).collect()}
    assert both == {("2", "reply"), ("3", "quote"), ("4", "quote")}
    last = {(r.id, r.twitter_type) for r in replies_and_quotes(posts, roots, per_root=1).collect()}
    assert last == {("2", "reply"), ("4", "quote")}
