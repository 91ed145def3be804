"""CSV rows with what was wrong with them: good ones and a quarantine, from one scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from signalweave.operators.once import computed_once
from signalweave.session import cut_lineage

FIELDS = "number of fields"
VALUES = "value of another type"


def read_csv_checked(spark: SparkSession, path: str | list[str], schema: str, header: bool = True, **options: str) -> DataFrame:
    """The columns of `schema`, and `file`, `line`, `rejected` and `reason` of every line of the files.

    A line of a file is a row (no line breaks in fields), so that large files are split.  `rejected` has the raw line
    and `reason` tells why where a line does not fit the schema; both are NULL for a good one.  Blank lines are left out,
    and lines count from 1, the header included.

    A line's number is its place in its split of the file plus the lines of the splits before that.  The texts are
    read and parsed once; use `good_rows` and `rejected_rows` on the result.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"),
    )
    kind = StructType.fromDDL(schema)
    strings = StructType([StructField(f.name, StringType()) for f in kind.fields])
    quoted = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad", "escape": '"', **options}

    def parsed(fields: StructType):
        return F.from_csv("value", StructType(fields.fields + [StructField("_bad", StringType())]).simpleString().removeprefix("struct<").removesuffix(">").replace(":", " "), quoted)

    typed = computed_once(lines, _row=parsed(kind), _text=parsed(strings))
    reason = F.when(F.col("_text._bad").isNotNull(), FIELDS).when(F.col("_row._bad").isNotNull(), VALUES)
    rows = computed_once(typed, reason=reason)
    fields = [F.col(f"_row.`{f.name}`").alias(f.name) for f in kind.fields]
    rows = cut_lineage(rows.select(*fields, "file", "_block", "_id", F.when(F.col("reason").isNotNull(), F.col("value")).alias("rejected"), "reason", (F.trim("value") == "").alias("_blank")))
    # One row per split of a file.
    splits = rows.groupBy("file", "_block").agg(F.min("_id").alias("_least"), F.count(F.lit(1)).alias("_lines"))
    earlier = W.partitionBy("file").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    splits = splits.withColumn("_before", F.coalesce(F.sum("_lines").over(earlier), F.lit(0))).drop("_lines")
    placed = rows.join(splits, ["file", "_block"]).withColumn("line", F.col("_id") - F.col("_least") + F.col("_before") + 1)
    wanted = placed.filter(~F.col("_blank"))
    if header:
        wanted = wanted.filter("line > 1")
    return wanted.select(*kind.fieldNames(), "file", "line", "rejected", "reason")


def good_rows(checked: DataFrame) -> DataFrame:
    return checked.filter("reason IS NULL").drop("file", "line", "rejected", "reason")


def rejected_rows(checked: DataFrame) -> DataFrame:
    """The quarantine: `file`, `line`, `reason` and the raw line."""
    return checked.filter("reason IS NOT NULL").select("file", "line", "reason", "rejected")
