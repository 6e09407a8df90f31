"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidepool.session import ensure_checkpoint_dir

#: The characters that separate words: blank, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, in order; none for NULL."""
    inner = F.btrim(text, F.lit(BLANKS))
    return F.when(F.length(inner) > 0, F.split(inner, BLANK_RUN)).otherwise(F.array().cast("array<string>"))


def bare(text: Column) -> Column:
    """A text without its word separators; empty for NULL."""
    return F.coalesce(F.translate(text, BLANKS, ""), F.lit(""))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    It cuts the lineage at a table that every executor can read, so a lost
    executor costs the tasks it was running and nothing that is already
    written. Files lie under the application's id, which is what a deployment
    clears when an application has ended.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_path = path
    return table


def settled(df: DataFrame, name: str) -> DataFrame:
    """``written``, and the shuffle files of what has been written so far go.

    Executors keep a shuffle's files until the driver's JVM collects what stands
    for it, which on a quiet heap may be long after the result is written; so it
    is told to collect now. For operators whose steps shuffle as much as they
    read.
    """
    table = written(df, name)
    gc.collect()
    df.sparkSession._jvm.System.gc()
    return table


def free(*tables: DataFrame) -> None:
    """Delete tables that ``written`` made, when all that is still to come reads tables written after them."""
    for table in tables:
        jvm, conf = table.sparkSession._jvm, table.sparkSession._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(table.written_path)
        path.getFileSystem(conf).delete(path, True)


def numbered(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` with ``number``, its rows' places (from 0) in ``order``.

    Rows are dealt out by range and written, counted by range, and numbered
    within their range from the sum of the counts before it. Only the counts,
    one for each range, meet in one task.
    """
    ranges = written(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "numbered")
    counts = ranges.groupBy("_range").count()
    before = counts.select("_range", (F.sum("count").over(W.orderBy("_range")) - F.col("count")).alias("_before"))
    at = F.row_number().over(W.partitionBy("_range").orderBy(*order))
    return (ranges.withColumn("_at", at).join(before, "_range")
            .withColumn("number", F.col("_before") + F.col("_at") - 1).drop("_range", "_before", "_at"))


def slices(batch: pa.RecordBatch, text: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """``batch`` in pieces of about ``most`` bytes of text column ``text``, one row at least.

    After the last one the worker gives back what its pieces have used.
    """
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(sizes) // most
    starts = np.r_[0, np.flatnonzero(np.diff(part)) + 1] if len(part) else np.zeros(0, dtype=np.int64)
    for a, b in zip(starts.tolist(), [*starts.tolist()[1:], batch.num_rows]):
        yield batch.slice(a, b - a)
    give_back()


#: glibc's call that returns freed memory to the system; other C libraries have none.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return freed memory to the system: a worker lives on from stage to stage, and what it keeps for itself counts as the executor's."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have, like ``name``."""
    while name.lower() in {c.lower() for c in df.columns}:
        name = f"_{name}"
    return name
