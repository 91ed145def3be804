"""From classified, country-tagged posts to monthly sentiment series."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalweave.functions.literals import parse_list
from signalweave.functions.temporal import to_day, to_month
from signalweave.operators.enrich import keep_members, negative_label, negative_score, recode, union_all
from signalweave.operators.ranking import keep_first
from signalweave.operators.series import counts_with_share, quartiles, trailing_stats
from signalweave.operators.tagging import explode_tags, tag_countries
from signalweave.sources.readers import Paths, category_from_file, read_csv
from signalweave.sources.schemas import GEO_POSTS, SENTIMENT_POSTS, TAGGED_POSTS

POST_COLUMNS = ("created_at", "text_processed", "id", "negative", "category", "country")


def read_sentiment_posts(spark: SparkSession, path: Paths, multi_line: bool = True) -> DataFrame:
    """A folder of post files, the category taken from the file name."""
    return read_csv(spark, path, SENTIMENT_POSTS, multi_line=multi_line).withColumn("category", category_from_file())


def tag_posts(posts: DataFrame, gazetteer: Mapping[str, Iterable[str]]) -> DataFrame:
    """Replace the `Country` text by the list of countries found in the post."""
    return tag_countries(posts, gazetteer)


def clean_posts(posts: DataFrame, dedupe: bool = True) -> DataFrame:
    """One row per post and country, with `negative`, `time` and `time_month`.

    Untagged posts go first, then copies of a post within its category (the earliest stays);
    columns are cut down before the shuffle of the de-duplication.
    """
    kept = posts.select("created_at", "text_processed", "id", "label", "category", "Country")
    as_text = dict(kept.dtypes)["Country"] == "string"
    kept = kept.filter(F.col("Country") != "[]" if as_text else F.size("Country") > 0)
    if dedupe:
        order = [F.asc("created_at"), F.asc("text_processed"), F.asc("label"), F.asc("Country")]
        kept = keep_first(kept, ["category", "id"], order)
    tags = parse_list("Country") if as_text else F.col("Country")
    rows = explode_tags(kept.withColumn("_tags", tags).drop("Country"), "_tags", "country")
    rows = rows.withColumn("negative", negative_label("label")).select(*POST_COLUMNS)
    return with_month(rows)


def with_month(rows: DataFrame) -> DataFrame:
    return rows.withColumn("time", to_day("created_at")).withColumn("time_month", to_month("time"))


def sentiment_series(rows: DataFrame) -> DataFrame:
    """Counts, negative share, trailing statistics and outlier flag per country and category."""
    return trailing_stats(counts_with_share(rows))


def cross_country_quartiles(series: DataFrame, country_map: DataFrame) -> DataFrame:
    """Recode countries, keep the mapped ones, add the quartiles across them."""
    named = recode(series, "country", country_map, "Identified_Country_Name", "IMF_Country_Name")
    return quartiles(keep_members(named, "country", country_map, "IMF_Country_Name"))


def merge_tagged_and_geo(
    spark: SparkSession, tagged: Paths, geo: Paths, country_map: DataFrame
) -> DataFrame:
    """Union of text-tagged and geo-coded posts, with common names, labels and countries."""
    t = read_csv(spark, tagged, TAGGED_POSTS).filter(F.col("Country") != "[]")
    t = explode_tags(t.withColumn("_tags", parse_list("Country")).drop("Country"), "_tags", "country")
    t = recode(t, "country", country_map, "Identified_Country_Name", "IMF_Country_Name")
    t = keep_members(t, "country", country_map, "IMF_Country_Name")
    t = t.withColumn("negative", negative_label("label")).withColumn("category", F.col("Market"))
    g = recode(read_csv(spark, geo, GEO_POSTS), "country", country_map, "2_Code", "IMF_Country_Name")
    g = g.withColumn("negative", negative_score("negative")).withColumnRenamed("new_text", "text_processed")
    return with_month(union_all([t.select(*POST_COLUMNS), g.select(*POST_COLUMNS)]))
