"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import free, settled, written


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node that each node of ``edges`` (x, y) is connected to.

    Large-star and small-star steps in turn: every node hands its larger
    neighbours, then its smaller ones, to the least node it sees, until each
    component is a star. Each step is two joins on an edge table that never
    gets larger, and is written, so that a lost executor repeats one step.
    """
    now = written(_down(edges.select("x", "y")), "edges")
    size = _mark(now)
    while True:
        both = now.unionAll(now.select(F.col("y").alias("x"), F.col("x").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select(F.col("x").alias("k"), F.least("x", "m").alias("m"))
        large = both.filter("y > x").join(least, F.col("x") == F.col("k")).select(F.col("y").alias("x"), F.col("m").alias("y"))
        large = written(_down(large), "large-star")
        least = large.groupBy("x").agg(F.min("y").alias("m")).withColumnRenamed("x", "k")
        small = large.join(least, F.col("x") == F.col("k"))
        before, now = now, settled(_down(small.select(F.col("y").alias("x"), F.col("m").alias("y")).unionAll(least.select("k", "m"))), "small-star")
        free(before, large)
        if size == (size := _mark(now)):
            break
    return now.select(F.col("x").alias("node"), F.col("y").alias("component")).unionAll(now.select("y", "y")).distinct()


def _down(edges: DataFrame) -> DataFrame:
    """Distinct edges from a larger to a smaller node."""
    return edges.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).filter("x <> y").distinct()


def _mark(edges: DataFrame) -> tuple:
    """Equal for equal edge tables."""
    hashed = F.xxhash64("x", "y").cast("decimal(20,0)")
    return tuple(edges.agg(F.count("*"), F.sum(hashed)).first())
