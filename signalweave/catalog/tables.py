"""The driver's tables in the roles the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalweave.functions.temporal import to_month
from signalweave.session import spread_rows


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_table(spark: SparkSession, folder: str, name: str, key: str) -> DataFrame:
    """A table of long texts, spread over the cores if it is small."""
    return spread_rows(table(spark, folder, name), key)


def labelled_posts(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as labelled posts: nation = country, priority = category, status F = negative."""
    orders = table(spark, folder, "orders").filter(F.col("o_custkey").isNotNull())
    users = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name")
    day = F.col("o_orderdate").cast("date")
    return (
        orders.join(users, orders["o_custkey"] == users["c_custkey"])
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").alias("id"),
            F.col("n_name").alias("country"),
            F.col("o_orderpriority").alias("category"),
            F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("negative"),
            to_month(day).alias("time_month"),
        )
    )


LABELLED_POSTS_SQL = """posts AS (
  SELECT o_orderkey AS id, n_name AS country, o_orderpriority AS category,
         CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS negative,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS time_month
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


def document_posts(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as posts, dated by id."""
    day = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("doc_id") % 730).cast("int"))
    return text_table(spark, folder, "documents", "doc_id").select(
        "doc_id", "text", "lang", "source", day.alias("time"), to_month(day).alias("time_month")
    )


DOCUMENT_MONTH_SQL = (
    "CAST(date_trunc('month', DATE '2020-01-01' + CAST(doc_id % 730 AS INTEGER)) AS DATE)"
)

# The counterpart of text search.  RE2's \\b knows ASCII only, so accented Latin letters are
# first mapped to a plain one; keywords in the checks are ASCII.
LATIN = "[À-ÖØ-öø-ɏ]"


def sql_plain(column: str = "text") -> str:
    return f"regexp_replace({column}, '{LATIN}', 'x', 'g')"


def sql_line(column: str = "text") -> str:
    return sql_plain(f"replace(replace({column}, chr(13), ''), chr(10), '')")


def sql_pattern(words, plural: bool = False, suffixes: str = "", casing: bool = False) -> str:
    """The whole-word alternation, spelled keyword by keyword, as an SQL string."""
    suffix = "(?:s|es)?" if plural else suffixes
    flags = "" if casing else "(?i)"
    body = "|".join(rf"\b{w}{suffix}\b" for w in words)
    return f"'{flags}{body}'"
