"""Exact quantiles by refined histograms."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _nth(df: DataFrame, rank: int, low, high, bins: int, most: int):
    """The value of ``rank`` (from 0) among the column ``_v`` of ``df``, all within [low, high]."""
    while low != high:
        inside = df.where((F.col("_v") >= F.lit(low)) & (F.col("_v") <= F.lit(high)))
        width = float(high) - float(low)
        if width > 0:
            bin_ = F.least(F.floor((F.col("_v").cast("double") - F.lit(float(low))) / F.lit(width) * bins), F.lit(bins - 1))
            rows = inside.groupBy(bin_.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.min("_v").alias("low"), F.max("_v").alias("high")).collect()
            for r in sorted(rows, key=lambda r: r["b"]):
                if rank < r["n"]:
                    break
                rank -= r["n"]
            narrower = (r["low"], r["high"]) != (low, high)
            low, high = r["low"], r["high"]
            if low == high or r["n"] > most and narrower:
                continue
        # Few values are left, or whole numbers that one double stands for: each with its count.
        inside = df.where((F.col("_v") >= F.lit(low)) & (F.col("_v") <= F.lit(high)))
        for v in sorted(inside.groupBy("_v").agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda v: v["_v"]):
            if rank < v["n"]:
                return v["_v"]
            rank -= v["n"]
    return low


def exact_quantile(df: DataFrame, col: str, q: float = 0.5, bins: int = 1024, most: int = 65_536):
    """The quantile ``q`` of a numeric column, between neighbours by linear interpolation, as a double; None without values.

    Passes count the values in ``bins`` equal parts of the range and go on in
    the part that holds the wanted one, until it holds ``most`` values at most;
    counts are combined map-side, so a value with any share of the rows is no
    large group, and no task or driver holds more than ``bins`` counts or
    ``most`` values. NULL and NaN are left out. It runs a job for each pass.
    """
    v = df.select(F.col(col).alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan(F.col("_v").cast("double")))
    n, low, high = v.agg(F.count(F.lit(1)), F.min("_v"), F.max("_v")).first()
    if not n:
        return None
    at = (n - 1) * q
    down = _nth(v, math.floor(at), low, high, bins, most)
    if at == math.floor(at):
        return float(down)
    upto, above = v.agg(F.count_if(F.col("_v") <= F.lit(down)), F.min(F.when(F.col("_v") > F.lit(down), F.col("_v")))).first()
    up = down if upto > math.ceil(at) else above
    return float(down) + (float(up) - float(down)) * (at - math.floor(at))
