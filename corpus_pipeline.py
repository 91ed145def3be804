"""The corpus pipeline: documents through quality rules, dedup, decontamination and packing.

Each stage is a function of the session, the documents that its predecessor kept, and the folder of
the tables.  The driver writes each stage's rows as Parquet and reads them again for the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalweave.llm import decontaminate, line_dedup, packing, quality_rules, simhash
from signalweave.llm.frames import documents, stored


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current quality policy keeps.

    NULL, empty and blank texts have no word and go; very long texts are measured whole.  Rows of one id, equal rows and rows
    without an id are judged one by one; columns of any other name stay as they are.
    """
    return quality_rules.accepted(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines of any length that repeat earlier ones; `n_chars`, if there, follows the text.

    A NULL text stays NULL with its `n_chars`, an empty one stays empty; a text of repeated lines only becomes empty or keeps its
    blank lines.  Every row is a document: of equal rows the later ones lose their lines, also without an id.
    """
    left = line_dedup.without_repeated_lines(docs, least=None, by_row=True)
    if "n_chars" not in docs.columns:
        return left
    chars = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return left.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(chars))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates: 4-word shingles, up to 4 differing bits.

    Texts without a word, NULL ones too, have fingerprint zero and are one group.  Of equal rows one stays, of rows of one
    id or none as many as they are in groups.
    """
    return simhash.one_of_each_group(docs, words=4, max_bits=4)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no item of the benchmark.

    NULL and empty texts contain nothing and stay, and NULL or empty items are in no document.  A row goes for its own text, whatever
    rows share its id.
    """
    return decontaminate.rows_without_items(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents, packed into sequences.

    A NULL or empty text is its end token; a very long one is cut into pieces.  Every row is packed, equal rows too.  No documents
    give no pieces.
    """
    return packing.pack(docs, with_ids=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", filter_quality),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

# SimHash components and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written to the shared folder before the next."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
