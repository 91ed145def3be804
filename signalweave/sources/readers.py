"""Batch sources: CSV, JSON result pages, XML, text and document tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalweave.functions.text import clean_line, contains_any
from signalweave.sources.schemas import RESULT_PAGES

Paths = str | list[str]


def read_csv(
    spark: SparkSession,
    path: Paths,
    schema: str,
    recursive: bool = False,
    suffix: str | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """CSV files below a path, folder or glob; rows that do not fit the schema are dropped.

    The schema is required: without it a row with surplus fields would be kept.  Texts may hold
    line breaks by default, for which a file has to be read by one task; pass `multi_line=False`
    for files with a row per line, so that large ones are split.
    """
    reader = spark.read.schema(schema).options(
        header=True, mode="DROPMALFORMED", multiLine=multi_line, escape='"'
    )
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    if suffix:
        reader = reader.option("pathGlobFilter", f"*{suffix}")
    return reader.csv(path)


def file_name() -> Column:
    """Base name of the file a row was read from."""
    return F.col("_metadata.file_name")


def category_from_file(name: Column | None = None) -> Column:
    """`nonmarket` where the file name says so, else `market`."""
    return F.when((file_name() if name is None else name).contains("nonmarket"), "nonmarket").otherwise(
        "market"
    )


def name_part(after: str, before: str = ".", name: Column | None = None) -> Column:
    """The part of the file name between two literal marks (a user, a country, a year)."""
    tail = F.substring_index(file_name() if name is None else name, after, -1)
    return F.substring_index(tail, before, 1)


def read_result_pages(spark: SparkSession, path: Paths, meta: bool = False) -> DataFrame:
    """Landed JSON result pages to one row per post; pages without results give no rows.

    With `meta` the page's `result_count` and `next_token` come with each of its posts; see
    `operators.pages` for the order of pages.
    """
    pages = spark.read.schema(RESULT_PAGES).json(path)
    kept = ["meta.result_count", "meta.next_token"] if meta else []
    rows = pages.select("meta", F.explode("data").alias("post"))
    return rows.select("post.*", *kept)


def total_results(spark: SparkSession, path: Paths) -> DataFrame:
    """Number of results announced by all pages."""
    pages = spark.read.schema(RESULT_PAGES).json(path)
    return pages.agg(F.coalesce(F.sum("meta.result_count"), F.lit(0)).alias("total_count"))


def read_gazetteer(spark: SparkSession, path: Paths, row_tag: str = "Country") -> DataFrame:
    """XML gazetteer to (country, aliases): names, nationalities, capital and major cities."""
    fields = ("CountryName", "Nationality", "Capital", "MajorCities")
    schema = ", ".join(f"{f} STRING" for f in fields)
    raw = spark.read.format("xml").schema(schema).option("rowTag", row_tag).load(path)

    def entries(field: str) -> Column:
        lines = F.split(F.lower(F.trim(F.coalesce(F.col(field), F.lit("")))), "\n")
        return F.filter(
            F.transform(lines, lambda v: F.trim(F.translate(v, "_\r\t", "   "))), lambda v: v != ""
        )

    return raw.select(
        F.array_join(entries("CountryName"), "").alias("country"),
        F.concat(*[entries(f) for f in fields]).alias("aliases"),
    )


def read_text_documents(
    spark: SparkSession,
    path: Paths,
    boilerplate: tuple[str, ...] = (),
    stop_phrases: tuple[str, ...] = (),
    recursive: bool = False,
) -> DataFrame:
    """Text files to (doc_id, paras): one cleaned paragraph per line, in file order.

    A file is one row, so its lines keep their order without a sort or a shuffle.  Lines that
    contain one of `stop_phrases` are left out.
    """
    reader = spark.read.option("recursiveFileLookup", recursive)
    files = reader.text(path, wholetext=True)
    lines = F.split(F.regexp_replace("value", r"\n\z", ""), "\n")
    if stop_phrases:
        lines = F.filter(lines, lambda line: ~contains_any(line, stop_phrases))
    return files.select(
        F.substring_index(file_name(), ".", 1).alias("doc_id"),
        F.transform(lines, lambda line: clean_line(line, boilerplate)).alias("paras"),
    )


def read_ids(spark: SparkSession, path: Paths, position: int = 3) -> DataFrame:
    """The id column of a metadata CSV, chosen by its 0-based position."""
    table = spark.read.options(header=True, multiLine=True, escape='"').csv(path)
    return table.select(F.col(f"`{table.columns[position]}`").alias("doc_id"))


def read_accounts(spark: SparkSession, path: Paths, column: str = "Name") -> DataFrame:
    """Account handles from a sheet: one distinct `username` per row, blanks dropped."""
    table = spark.read.options(header=True, multiLine=True, escape='"').csv(path)
    handle = F.trim(F.col(f"`{column}`"))
    return table.select(handle.alias("username")).filter(F.col("username") != "").distinct()
