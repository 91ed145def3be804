"""Sources and sinks over the driver's tables: each writes a table in a format of its own and reads it back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalweave.catalog.tables import LABELLED_POSTS_SQL, labelled_posts, table
from signalweave.functions.temporal import to_day, to_month
from signalweave.functions.text import strip_nbsp, without_connectors
from signalweave.operators.enrich import keep_members, negative_label, union_all
from signalweave.operators.rules import add_policies
from signalweave.operators.series import counts_with_share
from signalweave.plans.policies import write_policy_series
from signalweave.session import shared_folder, tasks_for_rows
from signalweave.sources import dictionaries, readers, writers

SCORED = "id BIGINT, created_at STRING, category STRING, label INT, price DOUBLE"
STOP_PHRASES = ("ring",)
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as exported posts: an ISO time, a class label, a number."""
    orders = table(spark, folder, "orders")
    label = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    return orders.select(
        F.col("o_orderkey").alias("id"), F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created_at"),
        F.col("o_orderpriority").alias("category"), label.alias("label"), F.col("o_totalprice").alias("price"),
    )


def csv_folders(spark: SparkSession, folder: str) -> DataFrame:
    """Posts exported as CSV to a folder per market, read by one glob; the market comes from the path."""
    posts, target = _scored(spark, folder), shared_folder(spark, "csv")
    writers.write_csv(posts.filter("id % 3 = 0"), f"{target}/nonmarket_posts")
    writers.write_csv(posts.filter("id % 3 > 0"), f"{target}/market_posts")
    read = readers.read_csv(spark, f"{target}/*_posts", SCORED, multi_line=False)
    market = readers.category_from_file(F.col("_metadata.file_path"))
    part = readers.name_part(f"{target.rstrip('/').rsplit('/', 1)[-1]}/", "_", F.col("_metadata.file_path"))
    rows = read.select("*", market.alias("market"), part.alias("part"))
    rows = rows.withColumn("time_month", to_month(to_day("created_at")))
    return rows.groupBy("market", "part", "category", "time_month").agg(
        F.count("id").alias("n"), F.sum(negative_label("label")).alias("negative"), F.round(F.sum("price"), 2).alias("price")
    )


def csv_recursive(spark: SparkSession, folder: str) -> DataFrame:
    """CSV in nested folders beside files of another suffix, with rows that do not fit the schema."""
    posts, target = _scored(spark, folder), shared_folder(spark, "nested")
    spoiled = posts.withColumn("price", F.when(F.col("id") % 29 == 7, F.lit("unknown")).otherwise(F.col("price").cast("string")))
    writers.write_csv(spoiled.filter("id % 2 = 0"), f"{target}/a/even")
    writers.write_csv(spoiled.filter("id % 2 = 1"), f"{target}/b/c/odd")
    posts.select(F.col("category").alias("value")).write.text(f"{target}/b/notes")
    return readers.read_csv(spark, target, SCORED, recursive=True, suffix=".csv", multi_line=False)


def _pages(spark: SparkSession, folder: str) -> str:
    """Orders landed as result pages, a hundred ids at most to a page, and a page without results per customer that has none."""
    columns = ("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    orders = table(spark, folder, "orders").filter("o_custkey IS NOT NULL").select(*columns)
    customers = table(spark, folder, "customer").select("c_custkey")
    tasks = tasks_for_rows(orders)
    post = F.struct(
        F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderpriority").alias("text"),
        F.col("o_custkey").cast("string").alias("author_id"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("created_at"),
        F.struct((F.col("o_orderkey") % 7).alias("like_count")).alias("public_metrics"),
    )
    # Dealt before they are gathered: pages hold few orders, so that gathering first shortens nothing and keeps a split's rows in memory.
    dealt = orders.withColumn("page", F.floor(F.col("o_orderkey") / 100)).repartition(tasks, "o_custkey", "page")
    full = dealt.groupBy("o_custkey", "page").agg(F.collect_list(post).alias("data"))
    token = F.md5(F.concat_ws("-", "o_custkey", "page"))
    full = full.select("data", F.struct(F.size("data").alias("result_count"), token.alias("next_token")).alias("meta"))
    active = orders.select("o_custkey").repartition(tasks, "o_custkey").distinct()
    idle = customers.repartition(tasks, "c_custkey").join(active, F.col("c_custkey") == F.col("o_custkey"), "left_anti")
    none = idle.select(F.struct(F.lit(0).alias("result_count"), F.lit(None).cast("string").alias("next_token")).alias("meta"))
    target = shared_folder(spark, "pages")
    union_all([full, none]).write.json(target)
    return target


def result_pages(spark: SparkSession, folder: str) -> DataFrame:
    """One row per post of the landed pages, with its page's count and token."""
    posts = readers.read_result_pages(spark, _pages(spark, folder), meta=True)
    return posts.select(
        "id", "author_id", "text", to_day("created_at").alias("day"), F.col("public_metrics.like_count").alias("likes"),
        "result_count", "next_token",
    )


def announced_results(spark: SparkSession, folder: str) -> DataFrame:
    return readers.total_results(spark, _pages(spark, folder))


def gazetteer_xml(spark: SparkSession, folder: str) -> DataFrame:
    """Nations with the names of their suppliers as an XML gazetteer, an entry per thousand suppliers; aliases as rows."""
    suppliers = table(spark, folder, "supplier").withColumn("block", F.floor(F.col("s_suppkey") / 1000))
    nations = table(spark, folder, "nation")
    named = suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    entry = named.groupBy("n_name", "block").agg(F.array_join(F.collect_list("s_name"), "\n").alias("cities"))

    def tag(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>"))

    country = F.concat(
        tag("CountryName", F.concat(F.lit("\n  "), F.col("n_name"), F.lit("\n"))),
        tag("Nationality", F.concat(F.col("n_name"), F.lit("_people"))), tag("Capital", F.lit("")), tag("MajorCities", F.col("cities")),
    )
    target = shared_folder(spark, "gazetteer")
    # A file is one XML document: its root holds the entries of a block of suppliers.
    whole = entry.select("block", tag("Country", country).alias("entry")).groupBy("block").agg(F.collect_list("entry").alias("entries"))
    root = tag("Countries", F.array_join("entries", "\n"))
    whole.select(root.alias("value")).write.option("maxRecordsPerFile", 1).text(target)
    return readers.read_gazetteer(spark, target).select("country", F.explode("aliases").alias("alias"))


def _sheet(spark: SparkSession, folder: str) -> str:
    """Parts as a wide sheet: capitals, no-break spaces and connectors in the names, blanks in a column."""
    hard = F.lit(" ")
    name = F.concat(hard, F.upper(F.replace("p_name", F.lit(" "), F.lit(" and "))), hard)
    kind = F.when(F.col("p_size") > 25, F.col("p_type")).otherwise(F.lit("\t"))
    target = shared_folder(spark, "sheet")
    writers.write_csv(table(spark, folder, "part").select(name.alias("Name"), kind.alias("Kind"), F.col("p_brand").alias("Brand")), target)
    return target


def search_sheet(spark: SparkSession, folder: str) -> DataFrame:
    """The sheet as (group, keyword) rows, lowered and freed from no-break spaces."""
    long = dictionaries.read_search_sheet(spark, _sheet(spark, folder), "parts")
    return long.groupBy("sheet", "group", "keyword").agg(F.count("pos").alias("n"))


def keyword_sheet(spark: SparkSession, folder: str) -> DataFrame:
    """The sheet with a clean-up of its own: no connectors, single blanks."""

    def clean(c: Column) -> Column:
        return F.regexp_replace(strip_nbsp(without_connectors(c)), " +", " ")

    long = dictionaries.read_keyword_sheet(spark, _sheet(spark, folder), clean_keys=clean)
    return long.groupBy("group", "keyword").agg(F.count("pos").alias("n"))


def rule_sheets(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as rule sheets, one per market segment, and a README that is none; a row per rule and include word."""
    customers, target = table(spark, folder, "customer"), shared_folder(spark, "rules")
    include = F.concat_ws(" | ", F.concat(F.lit("Nation "), F.col("c_nationkey").cast("string")), F.lit(""), F.col("c_mktsegment"))
    sheet = customers.select(
        F.concat(F.lit(" "), "c_name").alias("anchor"), include.alias("include"), F.lit(None).cast("string").alias("exclude"),
        F.col("c_mktsegment").alias("segment"),
    )
    found = []
    for name in (*SEGMENTS, "README"):
        part = sheet.filter(F.col("segment") == (SEGMENTS[0] if name == "README" else name)).drop("segment")
        writers.write_csv(part, f"{target}/{name}")
        found.append(dictionaries.read_rule_sheet(spark, f"{target}/{name}", name))
    rules = union_all(found)
    return rules.select("policy", "anchor", F.explode("include").alias("word"), F.size("exclude").alias("n_exclude"))


def joined_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Part types as rules with `_` in their anchors, applied to phrase-joined descriptions of the parts."""
    parts = table(spark, folder, "part")
    kinds = parts.select(F.concat(F.lit("of type "), F.lower("p_type")).alias("anchor")).distinct()
    sheet = kinds.select(F.lit("made").alias("policy"), "anchor", F.lit("small|large").alias("include"), F.lit("ring").alias("exclude"))
    target = shared_folder(spark, "joined")
    writers.write_csv(sheet.drop("policy"), target)
    book = dictionaries.rulebook(dictionaries.read_rule_sheet(spark, target, "made"), join_anchor=True)
    text = F.concat(F.lower("p_name"), F.lit(" of_type_"), F.lower("p_type"))
    tagged = add_policies(parts.select("p_partkey", text.alias("text")), book, "text")
    return tagged.select("p_partkey", F.size("policies").alias("n_policies"))


def text_files(spark: SparkSession, folder: str) -> DataFrame:
    """Part names as text files, one per brand and thousand parts, read as documents of cleaned lines."""
    doc = F.concat_ws("-", F.substring_index("p_brand", "#", -1), F.floor(F.col("p_partkey") / 1000).cast("string"))
    lines = table(spark, folder, "part").select(doc.alias("doc"), "p_partkey", F.col("p_name").alias("value"))
    target = shared_folder(spark, "texts")
    ordered = lines.repartition("doc").sortWithinPartitions("doc", "p_partkey")
    ordered.select("doc", "value").write.partitionBy("doc").text(target)
    docs = readers.read_text_documents(spark, target, stop_phrases=STOP_PHRASES, recursive=True)
    return docs.select(F.size("paras").alias("n_paras"), F.array_join("paras", "\n").alias("text"))


def listed_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Documents whose id stands in the fourth column of a metadata CSV."""
    docs = table(spark, folder, "documents")
    listed = docs.filter("doc_id % 4 != 1").select("source", "lang", "n_chars", "doc_id", F.lit('a "b",\nc').alias("note"))
    target = shared_folder(spark, "metadata")
    writers.write_csv(listed, target)
    ids = readers.read_ids(spark, target)
    return keep_members(docs.select(F.col("doc_id").cast("string").alias("doc_id"), "lang"), "doc_id", ids, "doc_id")


def listed_accounts(spark: SparkSession, folder: str) -> DataFrame:
    """Account handles of a sheet with blanks and repeats, and the orders of each."""
    orders = table(spark, folder, "orders")
    users = table(spark, folder, "customer").select("c_custkey", "c_name")
    name = F.when(F.col("o_orderkey") % 5 == 0, F.lit("\t")).otherwise(F.concat(F.lit("\t"), F.col("c_name"), F.lit("\t")))
    sheet = orders.join(users, F.col("o_custkey") == F.col("c_custkey")).select(name.alias("Name"), F.col("o_orderkey").alias("order"))
    target = shared_folder(spark, "accounts")
    writers.write_csv(sheet.withColumn("Name", F.translate("Name", "\t", " ")), target)
    return readers.read_accounts(spark, target)


def partitioned_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Posts as Parquet in a folder per country and year, read back and counted by the folders' names."""
    posts = writers.add_year(labelled_posts(spark, folder), "time_month")
    target = shared_folder(spark, "partitioned")
    writers.write_table(posts, target, ["country", "year"])
    return spark.read.parquet(target).groupBy("country", "year").agg(F.count("id").alias("n"), F.sum("negative").alias("negative"))


def table_reload(spark: SparkSession, folder: str) -> DataFrame:
    """Posts dumped as one Parquet table and reloaded, all columns."""
    target = shared_folder(spark, "dump")
    writers.write_table(labelled_posts(spark, folder), target)
    return spark.read.parquet(target)


def policy_folders(spark: SparkSession, folder: str) -> DataFrame:
    """A series per policy, each in a folder of its own, read back with the policy from the folder's name."""
    posts = labelled_posts(spark, folder).withColumnRenamed("category", "policy")
    series = counts_with_share(posts, keys=("policy", "country", "time_month"))
    target = shared_folder(spark, "policies")
    write_policy_series(series, target)
    return spark.read.parquet(target).select("policy", "country", "time_month", "negative", F.col("neutral-positive").alias("others"))


QUERIES = {
    "csv_folders": csv_folders,
    "csv_recursive": csv_recursive,
    "result_pages": result_pages,
    "announced_results": announced_results,
    "gazetteer_xml": gazetteer_xml,
    "search_sheet": search_sheet,
    "keyword_sheet": keyword_sheet,
    "rule_sheets": rule_sheets,
    "joined_rules": joined_rules,
    "text_files": text_files,
    "listed_ids": listed_ids,
    "listed_accounts": listed_accounts,
    "partitioned_tables": partitioned_tables,
    "table_reload": table_reload,
    "policy_folders": policy_folders,
}

_SCORED_SQL = """scored AS (
  SELECT o_orderkey AS id, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS created_at, o_orderpriority AS category,
         CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS label, o_totalprice AS price FROM orders)"""

_NAME = "upper(replace(p_name, ' ', ' and '))"

ORACLE = {
    "csv_folders": f"""WITH {_SCORED_SQL}
SELECT CASE WHEN id % 3 = 0 THEN 'nonmarket' ELSE 'market' END AS market, market AS part, category,
  CAST(date_trunc('month', CAST(substr(created_at, 1, 10) AS DATE)) AS DATE) AS time_month, count(*) AS n,
  CAST(sum(CASE WHEN label = 0 THEN 1 ELSE 0 END) AS BIGINT) AS negative, round(sum(price), 2) AS price
FROM scored GROUP BY ALL""",
    "csv_recursive": f"WITH {_SCORED_SQL} SELECT * FROM scored WHERE id % 29 <> 7",
    "result_pages": """SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS author_id, o_orderpriority AS text,
  CAST(o_orderdate AS DATE) AS day, o_orderkey % 7 AS likes, count(*) OVER (PARTITION BY o_custkey, o_orderkey // 100) AS result_count,
  md5(o_custkey || '-' || (o_orderkey // 100)) AS next_token
FROM orders WHERE o_custkey IS NOT NULL""",
    "announced_results": "SELECT count(o_custkey) AS total_count FROM orders",
    "gazetteer_xml": """WITH n AS (
  SELECT DISTINCT lower(n_name) AS name, s_suppkey // 1000 AS block FROM supplier JOIN nation ON s_nationkey = n_nationkey)
SELECT replace(name, '_', ' ') AS country, replace(name, '_', ' ') AS alias FROM n
UNION ALL SELECT replace(name, '_', ' '), replace(name, '_', ' ') || ' people' FROM n
UNION ALL SELECT replace(lower(n_name), '_', ' '), lower(s_name) FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "search_sheet": f"""WITH k AS (
  SELECT 'Name' AS "group", lower({_NAME}) AS keyword FROM part
  UNION ALL SELECT 'Kind', lower(p_type) FROM part WHERE p_size > 25
  UNION ALL SELECT 'Brand', lower(p_brand) FROM part)
SELECT 'parts' AS sheet, "group", keyword, count(*) AS n FROM k WHERE trim(keyword) <> '' GROUP BY ALL""",
    "keyword_sheet": """WITH k AS (
  SELECT 'Name' AS "group", regexp_replace(upper(p_name), ' +', ' ', 'g') AS keyword FROM part
  UNION ALL SELECT 'Kind', p_type FROM part WHERE p_size > 25
  UNION ALL SELECT 'Brand', p_brand FROM part)
SELECT "group", keyword, count(*) AS n FROM k WHERE trim(keyword) <> '' GROUP BY ALL""",
    "rule_sheets": """SELECT c_mktsegment AS policy, lower(c_name) AS anchor,
  unnest(['nation ' || c_nationkey, lower(c_mktsegment)]) AS word, 0 AS n_exclude
FROM customer WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')""",
    "joined_rules": r"""SELECT p_partkey,
  CASE WHEN regexp_matches(lower(p_name), '\b(small|large)\b') AND NOT regexp_matches(lower(p_name), '\bring\b') THEN 1 ELSE 0 END AS n_policies
FROM part""",
    "text_files": """SELECT CAST(count(*) FILTER (p_name NOT LIKE '%ring%') AS INTEGER) AS n_paras,
  coalesce(string_agg(p_name, chr(10) ORDER BY p_partkey) FILTER (p_name NOT LIKE '%ring%'), '') AS text
FROM part GROUP BY p_brand, p_partkey // 1000""",
    "listed_ids": "SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang FROM documents WHERE doc_id % 4 <> 1",
    "listed_accounts": """SELECT DISTINCT c_name AS username FROM orders JOIN customer ON o_custkey = c_custkey
WHERE o_orderkey % 5 <> 0""",
    "partitioned_tables": f"""WITH {LABELLED_POSTS_SQL}
SELECT country, CAST(year(time_month) AS INTEGER) AS year, count(*) AS n, CAST(sum(negative) AS BIGINT) AS negative FROM posts GROUP BY ALL""",
    "table_reload": f"WITH {LABELLED_POSTS_SQL} SELECT * FROM posts",
    "policy_folders": f"""WITH {LABELLED_POSTS_SQL}
SELECT category AS policy, country, time_month, count(*) FILTER (negative = 1) AS negative, count(*) FILTER (negative = 0) AS others
FROM posts GROUP BY ALL""",
}
