"""Coverage and match accounting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.functions.scalars import count_ratio


def _present(other: DataFrame, key: str) -> DataFrame:
    return other.select(F.col(key).alias("_key")).distinct().withColumn("_hit", F.lit(True))


def field_coverage(df: DataFrame, other: DataFrame, key: str, by: str, out: str = "coverage") -> DataFrame:
    """Share of rows per group that have a match in ``other`` (e.g. a label).

    ``other`` is reduced to its distinct keys before the join, so duplicated
    keys there cannot multiply rows here.
    """
    j = df.join(_present(other, key), df[key] == F.col("_key"), "left")
    agg = j.groupBy(by).agg(F.count(F.lit(1)).alias("documents"), F.count("_hit").alias("labelled"))
    return agg.withColumn(out, count_ratio("labelled", "documents"))


def column_coverage(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per column: non-missing rows over all rows (one aggregate)."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  *[count_ratio(F.count(c), F.count(F.lit(1))).alias(c) for c in cols])


def match_report(df: DataFrame, other: DataFrame, key: str, by: str) -> DataFrame:
    """Per group: rows, rows matched in ``other``, rows left unmatched.

    ``documents = matched + unmatched`` holds by construction.
    """
    j = df.join(_present(other, key), df[key] == F.col("_key"), "left")
    agg = j.groupBy(by).agg(F.count(F.lit(1)).alias("documents"), F.count("_hit").alias("matched"))
    return agg.withColumn("unmatched", F.col("documents") - F.col("matched"))


def unmatched(df: DataFrame, other: DataFrame, key: str, other_key: str | None = None) -> DataFrame:
    """Rows of ``df`` with no match in ``other`` (left anti join)."""
    ok = other_key or key
    return df.join(other, df[key] == other[ok], "left_anti")
