"""Rankings, shares, rollups, trends and totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.functions.scalars import count_ratio


def frequency(df: DataFrame, col: str | Sequence[str], out: str = "n") -> DataFrame:
    """Rows per value (the grouped count; order it or take ``top_k``)."""
    cols = [col] if isinstance(col, str) else list(col)
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias(out))


def top_k(df: DataFrame, col: str | Sequence[str], k: int, out: str = "n") -> DataFrame:
    """The k most frequent values, ties broken by the value itself.

    Planned as a TakeOrderedAndProject: each partition keeps its local top k,
    so only k rows per partition reach the final task.
    """
    cols = [col] if isinstance(col, str) else list(col)
    return frequency(df, cols, out).orderBy(F.col(out).desc(), *[F.col(c).asc() for c in cols]).limit(k)


def outcome_share(df: DataFrame, flag: str, out: str = "share") -> DataFrame:
    """Rows per outcome value and its share of all rows (denominator as a scalar subquery)."""
    total = df.select(F.count(F.lit(1))).scalar()
    per = df.groupBy(flag).agg(F.count(F.lit(1)).alias("n"))
    return per.withColumn(out, count_ratio(F.col("n"), total))


def membership_share(df: DataFrame, group: str, id_col: str, out: str = "share") -> DataFrame:
    """Distinct ids per group over distinct ids with any group.

    An id may belong to several groups, so shares can add up to more than 1.
    The denominator is a scalar subquery (one aggregate job), not a cross join.
    """
    d = df.where(F.col(group).isNotNull())
    total = d.select(F.countDistinct(id_col)).scalar()
    per = d.groupBy(group).agg(F.countDistinct(id_col).alias("works"))
    return per.withColumn(out, count_ratio(F.col("works"), total))


def region_rollup(df: DataFrame, levels: Sequence[str], id_col: str, out: str = "works") -> DataFrame:
    """Distinct ids at every level of a hierarchy (e.g. region > country) plus a total.

    Distinct counts cannot be summed up the levels: the links are made distinct
    at the finest level first, and each level is counted from the distinct
    links of the level below it. ``level`` is the grouping id (0 = finest).
    """
    keys = list(levels)
    links, parts = df.select(*keys, id_col).distinct(), []
    for k in range(len(keys), -1, -1):
        at = links if k == len(keys) else links.select(*keys[:k], id_col).distinct()
        level = F.lit((1 << (len(keys) - k)) - 1).alias("level")
        counted = at.groupBy(*keys[:k]).agg(F.count(id_col).alias(out)) if k else at.agg(F.count(id_col).alias(out))
        parts.append(counted.select(*[F.col(c) if c in keys[:k] else F.lit(None).cast(df.schema[c].dataType).alias(c) for c in keys], level, out))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def year_trend(df: DataFrame, date_col: str, split: str | None = None, year: str = "year",
               split_as: str | None = None, out: str = "n") -> DataFrame:
    """Rows per year, optionally split by a category."""
    keys = [F.year(date_col).alias(year)]
    if split:
        keys.append(F.col(split).alias(split_as or split))
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def trend_line(counts: DataFrame, year: str = "year", n: str = "n", by: Sequence[str] = (),
               before: int | None = None, complete: str | None = None) -> DataFrame:
    """Least-squares line through yearly counts, skipping incomplete recent years.

    Those are the years from ``before`` on, or those that the flag ``complete``
    of the counts denies (``lags.completeness`` tells).
    """
    c = counts if before is None else counts.where(F.col(year) < before)
    c = c if complete is None else c.where(F.col(complete))
    return c.groupBy(*by).agg(F.regr_slope(F.col(n).cast("double"), F.col(year).cast("double")).alias("slope"),
                              F.regr_intercept(F.col(n).cast("double"), F.col(year).cast("double"))
                              .alias("intercept"))


def sum_numeric(df: DataFrame, by: str | Sequence[str]) -> DataFrame:
    """Sum every numeric column per group; all-missing sums are 0.

    Integral columns sum to BIGINT; fractional ones to DOUBLE rounded to 6.
    """
    keys = [by] if isinstance(by, str) else list(by)
    aggs = []
    for f in df.schema.fields:
        if f.name in keys or not isinstance(f.dataType, T.NumericType):
            continue
        s = F.coalesce(F.sum(f.name), F.lit(0))
        if isinstance(f.dataType, T.IntegralType):
            aggs.append(s.cast("bigint").alias(f.name))
        else:
            aggs.append(F.round(s.cast("double"), 6).alias(f.name))
    return df.groupBy(*keys).agg(*aggs)


def add_total_row(df: DataFrame, label_col: str, label: str = "Total") -> DataFrame:
    """Append a totals row: numeric columns summed, ``label_col`` = ``label``."""
    sums = [F.sum(f.name).alias(f.name) for f in df.schema.fields
            if f.name != label_col and isinstance(f.dataType, T.NumericType)]
    total = df.agg(*sums).withColumn(label_col, F.lit(label))
    return df.unionByName(total, allowMissingColumns=True)


def distinct_works(df: DataFrame, key: str, id_col: str, name: str = "name", out: str = "works",
                   approx_rsd: float | None = None) -> DataFrame:
    """Distinct works per entity (the survey's name for ``network.distinct_counts``)."""
    from tidepool.operators.network import distinct_counts
    return distinct_counts(df, key, id_col, name, out, approx_rsd)
