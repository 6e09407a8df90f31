"""Rows of text files in file order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.session import materialize
from tidepool.sources.io import DEFAULT_NA, na_columns, text_scan


def read_in_order(spark: SparkSession, path: str | list[str], fmt: str = "text", schema: T.StructType | str | None = None,
                  number: str = "row_no", na_strings: tuple[str, ...] = DEFAULT_NA, **options) -> DataFrame:
    """A scan of text, CSV or JSON lines with ``number``: each row's place (from 0) over all files, by name, as they lie there.

    A file may be read in any number of blocks by as many tasks. A row's number
    is the count of the rows in the files and blocks before its own plus its
    place in its block. The first pass counts each block and notes where its
    numbering starts; the second adds. Only the table of blocks, one row for each
    scan task or so, is ordered; the rows are not sorted and not shuffled, as
    that table is broadcast. Options as in ``read_table``. Lines of a ``text``
    scan are in column ``value``.
    """
    given = spark.read.text(path) if fmt == "text" else text_scan(spark, path, fmt, schema, **options)
    columns = given.columns if fmt == "text" else na_columns(given, na_strings)
    # Numbers grow along a task's rows, and a block's rows are one run of them.
    rows = given.select(*columns, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
                        F.monotonically_increasing_id().alias("_at"))
    blocks = rows.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = F.sum("_n").over(W.orderBy("_file", "_block")) - F.col("_n")
    start = materialize(blocks.withColumn("_before", before).select(
        F.col("_file").alias("_f"), F.col("_block").alias("_b"), (F.col("_before") - F.col("_first")).alias("_start")))
    met = rows.join(F.broadcast(start), (F.col("_file") == F.col("_f")) & (F.col("_block") == F.col("_b")))
    return met.withColumn(number, F.col("_at") + F.col("_start")).drop("_file", "_block", "_at", "_f", "_b", "_start")
