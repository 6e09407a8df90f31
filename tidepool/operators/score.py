"""Weighted-criteria scoring and level distributions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidepool.session import materialize


def weighted_score(df: DataFrame, weights: Mapping[str, int | float], out: str = "total",
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """Sum of weights of the true criteria (boolean columns); NULL counts as false.

    The reference's weights were published only as an image, so they are a
    parameter here.
    """
    terms = [F.coalesce(F.col(c).cast("int"), F.lit(0)) * F.lit(w) for c, w in weights.items()]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    integral = all(float(w).is_integer() for w in weights.values())
    total = total.cast("bigint") if integral else total.cast("double")
    return df.select(*keep, total.alias(out)) if keep else df.withColumn(out, total)


def level_distribution(scored: DataFrame, level: str = "total", total_label: str = "Total") -> DataFrame:
    """Rows per level, cumulative "at least this level" counts, and a total row.

    The cumulative sum runs over the per-level counts only (one row per
    distinct level, bounded by the number of possible scores), never over the
    scored rows themselves.
    """
    per = materialize(scored.groupBy(level).agg(F.count(F.lit(1)).alias("documents")))
    down = W.orderBy(F.col(level).desc()).rowsBetween(W.unboundedPreceding, 0)
    levels = per.select(F.col(level).cast("string").alias("level"), "documents",
                        F.sum("documents").over(down).cast("bigint").alias("at_least"))
    total = per.agg(F.coalesce(F.sum("documents"), F.lit(0)).cast("bigint").alias("documents")).select(
        F.lit(total_label).alias("level"), "documents", F.col("documents").alias("at_least"))
    return levels.unionByName(total)


def band_counts(scored: DataFrame, level: str, cuts: tuple[int, ...] = (4, 6)) -> DataFrame:
    """Rows at or above each cut (e.g. level >= 4, >= 6) in one aggregate."""
    return scored.agg(*[F.count_if(F.col(level) >= c).alias(f"at_least_{c}") for c in cuts])
