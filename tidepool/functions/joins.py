"""Join helpers: broadcast only behind a size check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.session import materialize

# A side is broadcast only when it is proven to hold at most this many rows
# and at most this many (estimated) bytes.
DEFAULT_BROADCAST_ROWS = 1_000_000
DEFAULT_BROADCAST_BYTES = 256 << 20


def _row_bytes(df: DataFrame) -> Column:
    """Rough in-memory size of a row: string/binary lengths plus 8 bytes per
    other field (nested values are measured through their JSON text)."""
    parts: list[Column] = [F.lit(16)]
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)) + 8)
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            parts.append(F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)) + 8)
        else:
            parts.append(F.lit(8))
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total.cast("bigint")


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                      max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``df`` written once, and broadcast if it is proven small.

    The side is written to the shared folder, so the rows measured are the rows
    joined and are computed once; one parallel aggregate counts them and sums
    an estimate of their size. Beyond the bounds the join stays a shuffle join
    and AQE chooses the strategy from runtime sizes. Results are the same. It
    runs two jobs and keeps nothing in executor memory or on their disks.
    """
    side = materialize(df)
    size = side.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(_row_bytes(side)), F.lit(0)).alias("b")).first()
    return F.broadcast(side) if size["n"] <= max_rows and size["b"] <= max_bytes else side


def literal_table(spark, rows, schema) -> DataFrame:
    """Small constant table (stop lists, recode maps), broadcast; too many rows are an error."""
    rows = list(rows)
    if len(rows) > DEFAULT_BROADCAST_ROWS:
        raise ValueError(f"{len(rows)} rows are no literal table; write and join them instead")
    return F.broadcast(spark.createDataFrame(rows, schema))
