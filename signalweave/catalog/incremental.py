"""Interval join, page chains, checked CSV, counts by file and by batch over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from signalweave.catalog.tables import LABELLED_POSTS_SQL, labelled_posts, table
from signalweave.functions.temporal import to_month
from signalweave.operators.intervals import interval_join
from signalweave.operators.pages import chain_pages
from signalweave.operators.series import range_quantiles
from signalweave.session import shared_folder
from signalweave.sources.checked_csv import read_csv_checked
from signalweave.sources.manifest import count_new_files, folded_counts
from signalweave.streaming.deltas import compact, delta_writer, read_counts, run_deltas
from signalweave.streaming.monthly import read_arriving, stream_folders

KEYS = ("time_month", "country", "category", "negative")


def overlapping_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """Orders within the periods of one, three, twelve and forty months that begin with each month of the table."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice", F.col("o_orderdate").alias("ts"))
    bounds = orders.agg(F.trunc(F.min("ts"), "MM").alias("a"), F.trunc(F.max("ts"), "MM").alias("b"))
    months = bounds.select(F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("from_day"))
    periods = months.select("from_day", F.explode(F.array(*map(F.lit, (1, 3, 12, 40)))).alias("months"))
    periods = periods.withColumn("to_day", F.add_months("from_day", F.col("months")))
    met = interval_join(orders, periods, "ts", "from_day", "to_day")
    return met.groupBy("from_day", "months").agg(F.count(F.lit(1)).alias("n"), F.max("o_orderkey").alias("last_key"))


def page_chain(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as result pages of their source: each names the next one, some are lost and some landed twice."""
    docs = table(spark, folder, "documents").select("doc_id", "source")
    # Ten requests to each source, their pages in the order of ids.
    docs = docs.select("doc_id", F.concat_ws("-", "source", F.col("doc_id") % 10).alias("request"))
    order = Window.partitionBy("request").orderBy("doc_id")
    following = F.lead("doc_id").over(order)
    pages = docs.select(
        "request", "doc_id", F.when(F.row_number().over(order) > 1, F.md5(F.col("doc_id").cast("string"))).alias("token"),
        F.md5(following.cast("string")).alias("next_token"),
    ).filter("doc_id % 13 != 5")
    landed = pages.union(pages.filter("doc_id % 11 = 3")).repartition(8, "doc_id")
    return chain_pages(landed, ["request"])


CSV_SCHEMA = "o_orderkey BIGINT, o_orderdate DATE, o_totalprice DOUBLE, o_orderpriority STRING"


def csv_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Orders written as CSV, some with a field too many, too few or a value that is no number, and read with what was wrong."""
    orders = table(spark, folder, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    price = F.when(F.col("o_orderkey") % 17 == 3, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    line = F.concat_ws(",", "o_orderkey", day, price, F.concat(F.lit('"a, '), F.col("o_orderpriority"), F.lit('"')))
    line = F.when(F.col("o_orderkey") % 19 == 4, F.concat(line, F.lit(",surplus"))).otherwise(line)
    line = F.when(F.col("o_orderkey") % 23 == 5, F.concat_ws(",", "o_orderkey", day)).otherwise(line)
    target = shared_folder(spark, "quarantine")
    orders.select(line.alias("value")).write.text(target)
    checked = read_csv_checked(spark, target, CSV_SCHEMA, header=False)
    key = F.coalesce("o_orderkey", F.regexp_extract("rejected", r"^(\d+)", 1).cast("bigint"))
    return checked.select(
        key.alias("o_orderkey"), F.coalesce("reason", F.lit("good")).alias("state"),
        F.when(F.col("reason").isNull(), F.col("o_orderpriority")).alias("priority"), (F.col("line") > 0).alias("numbered"),
    )


def _yearly_files(posts: DataFrame, landing: str, which: str) -> None:
    posts.filter(which).withColumn("year", F.year("time_month")).write.mode("append").partitionBy("year").parquet(landing)


def counts_by_file(spark: SparkSession, folder: str) -> DataFrame:
    """Posts that land in two parts and are counted after each; the second run reads the new files only."""
    posts = labelled_posts(spark, folder)
    landing, store = shared_folder(spark, "landing"), shared_folder(spark, "manifest")
    for part in ("time_month < DATE '1998-01-01'", "time_month >= DATE '1998-01-01'"):
        _yearly_files(posts, landing, part)
        count_new_files(spark, landing, store, KEYS, lambda rows: rows)
    return folded_counts(spark, store, KEYS)


def stream_delta_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Events as deltas of batches, of which the last is run again, and a part that arrives after a compaction."""
    events = table(spark, folder, "events")
    landing = shared_folder(spark, "arriving")
    target, state = stream_folders(spark, "deltas")

    def posts(rows: DataFrame) -> DataFrame:
        return rows.select(
            F.col("event_id").alias("id"), to_month(F.col("ts").cast("date")).alias("time_month"), F.col("user_id").alias("country"),
            F.col("event_type").alias("category"), F.when(F.col("value") < 20, 1).otherwise(0).alias("negative"),
        )

    # The later half of the month comes first, so that all of the second part is late.
    for part in ("day(ts) > 15", "day(ts) <= 15"):
        events.filter(part).write.mode("append").parquet(landing)
        run_deltas(posts(read_arriving(spark, landing, events.schema, files_per_batch=1)), target, state, KEYS)
        if part == "day(ts) > 15":
            compact(spark, target, KEYS)
    # What a restart after a failure does: the last batch once more.
    number = spark.read.parquet(f"{target}/delta").agg(F.max("batch")).first()[0]
    again = spark.read.parquet(f"{target}/delta/batch={number}")
    repeated = again.select(*KEYS, F.explode(F.sequence(F.lit(1), "id_count")).alias("id"))
    delta_writer(f"{target}/replayed", KEYS)(repeated, number)
    delta_writer(target, KEYS)(spark.read.parquet(f"{target}/replayed/delta").select(*KEYS, F.explode(F.sequence(F.lit(1), "id_count")).alias("id")), number)
    return read_counts(spark, target, KEYS)


def price_quartiles(spark: SparkSession, folder: str) -> DataFrame:
    """Quartiles of the prices of each order state, and so of very large groups."""
    found = range_quantiles(table(spark, folder, "orders"), ["o_orderstatus"], "o_totalprice")
    return found.select("o_orderstatus", "n", *[F.round(c, 4).alias(c) for c in ("q25", "q50", "q75")])


QUERIES = {
    "price_quartiles": price_quartiles,
    "overlapping_ranges": overlapping_ranges,
    "page_chain": page_chain,
    "csv_quarantine": csv_quarantine,
    "counts_by_file": counts_by_file,
    "stream_delta_counts": stream_delta_counts,
}

ORACLE = {
    "price_quartiles": """SELECT o_orderstatus, count(o_totalprice) AS n, round(quantile_cont(o_totalprice, 0.25), 4) AS q25,
  round(quantile_cont(o_totalprice, 0.5), 4) AS q50, round(quantile_cont(o_totalprice, 0.75), 4) AS q75
FROM orders GROUP BY o_orderstatus""",
    "overlapping_ranges": """WITH b AS (SELECT date_trunc('month', min(o_orderdate)) AS a, date_trunc('month', max(o_orderdate)) AS b FROM orders),
m AS (SELECT unnest(generate_series(a, b, INTERVAL 1 MONTH)) AS f FROM b),
p AS (SELECT f, months, f + to_months(months) AS t FROM m, (SELECT unnest([1, 3, 12, 40]) AS months))
SELECT CAST(f AS DATE) AS from_day, months, count(*) AS n, max(o_orderkey) AS last_key
FROM orders JOIN p ON o_orderdate >= f AND o_orderdate < t GROUP BY ALL""",
    "page_chain": """WITH RECURSIVE d AS (
  SELECT doc_id, source || '-' || (doc_id % 10) AS request, row_number() OVER w AS n, lead(doc_id) OVER w AS f
  FROM documents WINDOW w AS (PARTITION BY source, doc_id % 10 ORDER BY doc_id)),
p AS (
  SELECT doc_id, request, CASE WHEN n > 1 THEN md5(doc_id::VARCHAR) ELSE '' END AS token, md5(f::VARCHAR) AS next_token,
         1 + (doc_id % 11 = 3)::BIGINT AS copies
  FROM d WHERE doc_id % 13 <> 5),
c AS (
  SELECT request, token, token AS segment, 0::BIGINT AS position FROM p
  WHERE token = '' OR NOT EXISTS (SELECT 1 FROM p AS q WHERE q.request = p.request AND q.next_token = p.token)
  UNION ALL
  SELECT p.request, p.token, segment, position + 1 FROM c JOIN p AS o ON o.request = c.request AND o.token = c.token
    JOIN p ON p.request = o.request AND p.token = o.next_token)
SELECT p.request, p.token, next_token, copies, segment, position, CASE WHEN segment = '' THEN 'whole' ELSE 'cut' END AS status,
       next_token IS NOT NULL AND NOT EXISTS (SELECT 1 FROM p AS q WHERE q.request = p.request AND q.token = p.next_token) AS missing_next
FROM p JOIN c USING (request, token)""",
    "csv_quarantine": """SELECT o_orderkey,
  CASE WHEN o_orderkey % 23 = 5 OR o_orderkey % 19 = 4 THEN 'number of fields' WHEN o_orderkey % 17 = 3 THEN 'value of another type' ELSE 'good' END AS state,
  CASE WHEN state = 'good' THEN 'a, ' || o_orderpriority END AS priority, true AS numbered
FROM orders""",
    "counts_by_file": f"""WITH {LABELLED_POSTS_SQL}
SELECT time_month, country, category, negative, count(id) AS id_count FROM posts GROUP BY ALL""",
    "stream_delta_counts": """SELECT CAST(date_trunc('month', ts) AS DATE) AS time_month, user_id AS country,
  event_type AS category, CASE WHEN value < 20 THEN 1 ELSE 0 END AS negative, count(event_id) AS id_count
FROM events GROUP BY ALL""",
}
