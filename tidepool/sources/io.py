"""Scans and sinks: CSV/delimited, JSON lines, Parquet, graph documents.

Every reader takes an explicit schema (no type inference on large inputs) and
stays lazy; nothing here caches or collects.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Missing-value spellings. The reference's CSV reader also treats the text
# "NA" as missing, which silently turns the ISO code of Namibia into NULL.
# We keep Namibia by default; pass REFERENCE_NA to reproduce the old reading.
DEFAULT_NA: tuple[str, ...] = ("",)
# What a quoted empty field is read as, until it becomes an empty text.
QUOTED_EMPTY = "\x00"
REFERENCE_NA: tuple[str, ...] = ("", "NA")

CORPUS_SCHEMA = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("text", T.StringType()),
])

GRAPH_SCHEMA = T.StructType([
    T.StructField("nodes", T.ArrayType(T.StructType([
        T.StructField("name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("symbolSize", T.DoubleType()),
    ]))),
    T.StructField("links", T.ArrayType(T.StructType([
        T.StructField("source", T.StringType()),
        T.StructField("target", T.StringType()),
    ]))),
    T.StructField("categories", T.ArrayType(T.StructType([
        T.StructField("name", T.StringType()),
    ]))),
])


def read_table(spark: SparkSession, path: str | Sequence[str], fmt: str = "parquet",
               schema: T.StructType | str | None = None, sep: str = ",",
               na_strings: Sequence[str] = DEFAULT_NA, header: bool = True,
               multi_line: bool = False, bad_records: str | None = None) -> DataFrame:
    """Lazy scan of CSV / delimited text / JSON lines / Parquet.

    For text formats ``schema`` is required. CSV headers are checked against
    it (another name or order is an error), a doubled quote inside quotes is
    one quote, and ``multi_line`` allows line ends inside quotes. Nothing
    between two separators is NULL, and so is every string in ``na_strings``;
    without ``""`` among them a quoted empty text is an empty text. A record that does not fit the schema fails the job, or, with
    ``bad_records``, its text goes to that column and the rest is NULL.
    """
    paths = [path] if isinstance(path, str) else list(path)
    if fmt == "parquet":
        reader = spark.read
        if schema is not None:
            reader = reader.schema(schema)
        return reader.parquet(*paths)
    df = text_scan(spark, paths, fmt, schema, sep, header, multi_line, bad_records, "" in na_strings)
    return df if fmt == "json" else df.select(na_columns(df, na_strings))


def text_scan(spark: SparkSession, paths: str | Sequence[str], fmt: str, schema: T.StructType | str | None, sep: str = ",",
              header: bool = True, multi_line: bool = False, bad_records: str | None = None, empty_is_na: bool = True) -> DataFrame:
    """The scan below ``read_table``, before NA marks become NULL."""
    if schema is None:
        raise ValueError(f"{fmt} scans need an explicit schema")
    if fmt in ("csv", "delim"):
        return (_text_reader(spark, schema, bad_records).option("header", header).option("sep", sep).option("quote", '"')
                .option("escape", '"').option("multiLine", multi_line).option("enforceSchema", False)
                .option("emptyValue", "" if empty_is_na else QUOTED_EMPTY).csv(paths))
    if fmt == "json":
        return _text_reader(spark, schema, bad_records).option("multiLine", multi_line).json(paths)
    raise ValueError(f"unknown format {fmt!r}")


def _text_reader(spark: SparkSession, schema: T.StructType | str, bad_records: str | None):
    if bad_records is None:
        return spark.read.schema(schema).option("mode", "FAILFAST")
    if isinstance(schema, str):
        schema = spark.createDataFrame([], schema).schema
    whole = T.StructType([*schema.fields, T.StructField(bad_records, T.StringType())])
    return spark.read.schema(whole).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", bad_records)


def read_corpus(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Web corpus as JSON lines ``{url, text}`` over a glob (e.g. ``en/*``)."""
    return read_table(spark, path, fmt="json", schema=CORPUS_SCHEMA)


def na_columns(df: DataFrame, na_strings: Sequence[str]) -> list:
    """The columns of ``df``, with every spelling in ``na_strings`` as NULL in those of text."""
    extra = [s for s in na_strings if s != ""]
    if not extra and "" in na_strings:
        return [F.col(f"`{c}`") for c in df.columns]
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            c = F.when(c.isin(*extra), F.lit(None)).when(c == QUOTED_EMPTY, F.lit("")).otherwise(c).alias(f.name)
        cols.append(c)
    return cols


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                na_string: str = "", partition_by: Sequence[str] = (), sep: str = ",") -> None:
    """Write Parquet, CSV (header; doubled quotes inside quotes; ``sep`` between cells) or JSON lines.

    NULL is written as ``na_string``, by default as nothing, and an empty text
    as two quotes, so that both come back from ``read_table`` with no
    ``na_strings``. With another ``na_string`` a text that equals it could not be told from NULL, so such a
    text fails the job.
    """
    # Text keeps whole microseconds; the writer's own format would cut them to milliseconds.
    times = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    w = df.write.mode(mode).options(**({} if fmt == "parquet" else times))
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "parquet":
        w.parquet(path)
    elif fmt == "csv":
        if na_string:
            df = df.select([F.when(F.col(f"`{f.name}`") == na_string, F.raise_error(F.lit(f"a text equals the NA mark {na_string}")).cast("string"))
                            .otherwise(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
                            for f in df.schema.fields])
            w = df.write.mode(mode).options(**times)
            w = w.partitionBy(*partition_by) if partition_by else w
        (w.option("header", True).option("sep", sep).option("nullValue", na_string).option("emptyValue", '""').option("quote", '"')
         .option("escape", '"').csv(path))
    elif fmt == "json":
        w.json(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")


def write_graph_document(nodes: DataFrame, links: DataFrame, categories: DataFrame, path: str) -> None:
    """Write a graph as JSON lines in ``nodes``, ``links`` and ``categories`` under ``path``.

    Every part is written in parallel, whatever its size.
    """
    parts = {
        "nodes": nodes.select(F.col("name").cast("string").alias("name"), F.col("category").cast("string").alias("category"),
                              F.col("value").cast("double").alias("value"), F.col("symbol_size").cast("double").alias("symbolSize")),
        "links": links.select(F.col("source").cast("string").alias("source"), F.col("target").cast("string").alias("target")),
        "categories": categories.select(F.col("name").cast("string").alias("name")),
    }
    for name, part in parts.items():
        part.write.mode("overwrite").json(f"{path.rstrip('/')}/{name}")


def read_graph_parts(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes, links, categories) of a graph that ``write_graph_document`` wrote."""
    return tuple(spark.read.schema(GRAPH_SCHEMA[name].dataType.elementType).json(f"{path.rstrip('/')}/{name}")
                 for name in ("nodes", "links", "categories"))


def read_graph_document(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Read a graph from one foreign JSON document as (nodes, links, categories) frames.

    A document missing any of the three arrays is rejected (the chart code in
    the reference guards the same way).
    """
    doc = spark.read.schema(GRAPH_SCHEMA).option("multiLine", True).json(path)
    # A filter (not a dropped column) so the optimizer cannot prune the guard.
    checked = doc.where(
        F.when(F.col("nodes").isNull() | F.col("links").isNull() | F.col("categories").isNull(),
               F.raise_error(F.lit("graph document lacks nodes, links or categories")))
        .otherwise(F.lit(True)))
    nodes = checked.select(F.inline("nodes"))
    links = checked.select(F.inline("links"))
    cats = checked.select(F.inline("categories"))
    return nodes, links, cats
