"""Reporting lag: how complete recent periods are, estimated from older ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidepool.session import materialize


def _period(date: str, months: int) -> Column:
    return F.floor((F.year(date) * 12 + F.month(date) - 1) / F.lit(months)).cast("int")


def lag_counts(df: DataFrame, event: str, report: str, months: int = 12) -> DataFrame:
    """(period, lag, n): rows by the period of their event and the whole periods until their report.

    Rows without a date, or reported before their event, are left out. One
    combined aggregate; what comes out is bounded by the calendar.
    """
    p, r = _period(event, months), _period(report, months)
    return (df.where(F.col(report) >= F.col(event)).select(p.alias("period"), (r - p).alias("lag"))
            .groupBy("period", "lag").agg(F.count(F.lit(1)).alias("n")))


def completeness(counts: DataFrame, last: int | None = None, least: float = 0.95) -> DataFrame:
    """(period, n, completeness, estimated, complete) of each period, as seen at the end of period ``last``.

    A record is only seen when its lag is over, so late periods lack those
    still to come (right-truncated lags). The share of lag j among records with
    lags up to j is taken from the periods old enough to show lag j; going
    back from the longest lag, the share of records with a lag up to k is the
    product of one minus those shares. A period that has had k periods to be
    reported is complete to that share, ``complete`` where it is at least
    ``least``. ``last`` is the latest period of a report unless given (an
    earlier one looks at the data as of then). Shares are rounded to 6 places.
    """
    counts = materialize(counts)
    if last is None:
        last = counts.agg(F.max(F.col("period") + F.col("lag"))).first()[0]
    seen = counts.where(F.col("period") + F.col("lag") <= F.lit(last))
    longest = seen.agg(F.max("lag")).first()[0]
    if longest is None:
        return counts.select("period", "n", F.lit(1.0).alias("completeness"), F.lit(1.0).alias("estimated"), F.lit(True).alias("complete")).limit(0)
    # A record of lag i is among those with lags up to j, for each j that its period is old enough to show.
    upto = seen.select("n", "lag", F.explode(F.sequence("lag", F.least(F.lit(longest), F.lit(last) - F.col("period")))).alias("j"))
    by_lag = upto.groupBy("j").agg(F.sum("n").alias("all"), F.sum(F.when(F.col("lag") == F.col("j"), F.col("n")).otherwise(0)).alias("new"))
    later = W.orderBy(F.desc("j")).rowsBetween(W.unboundedPreceding, -1)
    kept = F.col("all") - F.col("new")
    share = materialize(by_lag.select(F.col("j").alias("age"), F.coalesce(F.sum(F.when(kept > 0, F.ln(kept / F.col("all"))).otherwise(0.0)).over(later), F.lit(0.0)).alias("ln"),
                          F.coalesce(F.max((kept == 0).cast("int")).over(later), F.lit(0)).alias("none")))
    periods = seen.groupBy("period").agg(F.sum("n").alias("n")).withColumn("_age", F.least(F.lit(longest), F.lit(last) - F.col("period")))
    met = periods.join(F.broadcast(share), F.col("_age") == F.col("age"))  # one row for each lag
    done = F.when(F.col("none") == 1, 0.0).otherwise(F.exp("ln"))
    return met.select("period", "n", F.round(done, 6).alias("completeness"), F.round(F.try_divide("n", done), 6).alias("estimated"),
                      (F.round(done, 6) >= least).alias("complete"))
