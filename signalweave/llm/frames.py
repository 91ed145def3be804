"""Helpers shared by the text operators: batches of texts in tasks, shared tables, row identity."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from signalweave.session import shared_folder, spread_rows

SLICE_BYTES = 8 << 20


def slices(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about SLICE_BYTES of text, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, before + SLICE_BYTES, side="right")))
        yield batch.slice(at, stop - at)
        at = stop


def utf8(batch: pa.RecordBatch, text: str) -> list[bytes]:
    """The texts of a batch as UTF-8; NULL counts as empty."""
    column = batch.column(text).cast(pa.binary())
    return pc.fill_null(column, b"").to_pylist()


def map_texts(
    df: DataFrame,
    fields: str,
    measure: Callable[[], Callable[[list[bytes]], Iterable]],
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """One output row per input row: the kept columns and `fields`, computed from the whole text.

    `measure()` is called once in each task, for models and caches; what it returns turns a list of
    UTF-8 texts into one sequence of values per field.  Only the kept columns and the text leave the
    scan, so other columns, whatever their names, play no part.
    """
    kept = df.select(*[df[c] for c in keep], df[text].alias("_text"))
    schema = StructType(kept.schema.fields[:-1] + StructType.fromDDL(fields).fields)
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = measure()
        for batch in batches:
            for part in slices(batch, "_text"):
                columns = [part.column(c) for c in keep]
                for got in values(utf8(part, "_text")):
                    columns.append(got if isinstance(got, pa.Array) else pa.array(got))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return kept.mapInArrow(run, schema)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write `df` to the shared folder and read it back.

    Later jobs start from the files, so nothing above is computed twice or lost with an executor.
    """
    spark = df.sparkSession
    folder = shared_folder(spark, purpose)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def release(spark: SparkSession, *tables: DataFrame) -> None:
    """Remove stored tables that no later step reads, and the shuffle files of finished steps.

    Spark deletes a shuffle's files once the driver has collected the objects that refer to it.  A
    driver with memory to spare may not do so for the whole of a job, hence the request.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for table in tables:
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)
    gc.collect()
    jvm.System.gc()


def small(df: DataFrame, weight: Column | None = None, most: int = 500_000) -> DataFrame:
    """`df`, marked for broadcast if its rows weigh no more than `most` numbers in all.

    A larger table stays as it is, and Spark shuffles both sides of the join.
    """
    total = df.agg(F.sum(F.lit(1) if weight is None else 1 + weight)).first()[0] or 0
    return F.broadcast(df) if total <= most else df


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """The table `documents`, dealt out to the cores if it has fewer splits than these."""
    return spread_rows(spark.read.parquet(f"{folder}/documents.parquet"), "doc_id")
