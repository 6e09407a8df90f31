"""Sharding by proportional stratified interleaving.

The rows of each source are put into a seeded random order (MD5 of the seed and
the order columns' first one) and numbered in it; row r of n has the fractional
rank (2 r + 1) / (2 n). All rows are sorted by it and the sequence is cut into
shards of equal counts, so each shard, and each stretch of a shard, holds the
sources in their overall proportions.

A source may hold any share of the rows: rows are dealt out by range of
(source, hash), counted by (range, source), and numbered within their range from
the sum of the counts before it; no source meets in one task. The global order
is numbered alike. Only counts by range are summed over.

Stated cases. NULL sources are one source of their own. Rows that agree in the
hash and in all order columns are interchangeable; repeated rows stay separate
rows. NULL order columns come first. An empty table gives an empty result. With
fewer rows than shards some shards are empty. Equal texts are not kept together:
a group with a third of all rows would break the equal counts. Given columns
named ``shard`` or ``slot`` are replaced; all others stay.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidepool.llm.common import free, numbered, written


def interleave(df: DataFrame, shards: int = 40, seed: int = 0, source: str = "source",
               order: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``df`` with ``shard`` (0 to shards - 1, counts at most one apart) and ``slot`` (place there, from 0).

    ``order``: the first column is hashed, the others break ties. The result
    depends on the rows and the seed alone, not on how they are laid out.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(order[0]).cast("string"), F.lit(""))).cast("binary"))
    # A written number tells apart rows that agree in all else, so that even those can be dealt out.
    rows = written(df.select(F.struct(*[c for c in df.columns if c.lower() not in ("shard", "slot")]).alias("row"),
                             F.col(source).alias("source"), F.struct(digest.alias("digest"), *order).alias("key"),
                             F.monotonically_increasing_id().alias("salt")), "shard-rows")
    ranges = written(rows.repartitionByRange("source", "key", "salt").withColumn("range", F.spark_partition_id()), "shard-ranges")
    counts, of_source = ranges.groupBy("range", "source").agg(F.count(F.lit(1)).alias("n")), W.partitionBy("source")
    before = counts.select(F.col("range").alias("r"), F.col("source").alias("s"), F.sum("n").over(of_source).alias("total"),
                           (F.sum("n").over(of_source.orderBy("range")) - F.col("n")).alias("before"))
    at = F.row_number().over(W.partitionBy("range", "source").orderBy("key", "salt"))
    ranked = (ranges.withColumn("at", at)
              .join(before, (F.col("range") == F.col("r")) & F.col("source").eqNullSafe(F.col("s")))
              .withColumn("fraction", (2 * (F.col("before") + F.col("at")) - 1).cast("double") / (2 * F.col("total")).cast("double"))
              .select("row", "source", "key", "salt", "fraction"))
    total, = ranges.agg(F.count(F.lit(1))).first()
    placed = numbered(ranked, F.col("fraction"), F.col("key"), F.col("source"), F.col("salt"))
    free(rows, ranges)
    shard = F.expr(f"number * {shards} div {max(total, 1)}")
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return (placed.withColumn("shard", shard).withColumn("slot", F.col("number") - first)
            .select("row.*", F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot")))


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write the rows as ``path/shard=K/``, each shard's files in the order of the slots, a shard by many tasks."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
