"""Scalar helpers: rescaling, binomial extraction, pair keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Uninomial / binomial: first blank-delimited word, then the next one.
FIRST_WORD = r"^([^ ]+)"
# Wide enough for a count times any scale used here.
WHOLE = "decimal(25,0)"
SECOND_WORD = r"^[^ ]+ +([^ ]+)"


def rescale_column(df: DataFrame, col: str, lo: float, hi: float, digits: int | None = None) -> Column:
    """Linear map of ``col`` onto [lo, hi] using the table's min and max.

    min/max come from one scalar subquery over ``df`` (Spark merges both into a
    single aggregate job): no cross join and no un-partitioned window. When
    max = min every value maps to the midpoint. With ``digits`` the result is
    rounded half-up; for an integral column and integral bounds the value is
    the exact fraction (lo*(mx-mn) + (hi-lo)*(v-mn)) / (mx-mn), rounded in
    integer arithmetic, so ties do not depend on binary doubles.
    """
    mn = df.select(F.min(col)).scalar()
    mx = df.select(F.max(col)).scalar()
    mid = F.lit((lo + hi) / 2.0)
    integral = (isinstance(df.schema[col].dataType, T.IntegralType)
                and float(lo).is_integer() and float(hi).is_integer())
    if digits is not None and integral:
        span = mx.cast(WHOLE) - mn.cast(WHOLE)
        num = F.lit(int(lo)) * span + F.lit(int(hi - lo)) * (F.col(col).cast(WHOLE) - mn.cast(WHOLE))
        return F.when(mx == mn, mid).otherwise(count_ratio(num, span, digits))
    span = (mx - mn).cast("double")
    scaled = F.lit(float(lo)) + (F.col(col) - mn).cast("double") * F.lit(float(hi - lo)) / span
    value = F.when(mx == mn, mid).otherwise(scaled)
    return F.round(value, digits) if digits is not None else value


def genus(name: str | Column) -> Column:
    c = F.col(name) if isinstance(name, str) else name
    return F.regexp_extract(c, FIRST_WORD, 1)


def epithet(name: str | Column) -> Column:
    c = F.col(name) if isinstance(name, str) else name
    return F.nullif(F.regexp_extract(c, SECOND_WORD, 1), F.lit(""))


def unordered_pair(a: str | Column, b: str | Column) -> Column:
    """Order-free pair key as a struct; never a joined string (names may hold '-')."""
    ca = F.col(a) if isinstance(a, str) else a
    cb = F.col(b) if isinstance(b, str) else b
    return F.struct(F.least(ca, cb).alias("lo"), F.greatest(ca, cb).alias("hi"))


def count_ratio(num: str | Column, den: str | Column, digits: int = 6) -> Column:
    """``num / den`` for non-negative counts, rounded half-up to ``digits``
    places exactly (whole decimals, up to 10**25), as a double; NULL when ``den`` is 0.

    Rounding the floating quotient instead would depend on how an engine
    rounds binary doubles at ties such as 41/640 = 0.0640625.
    """
    n = (F.col(num) if isinstance(num, str) else num).cast(WHOLE)
    d = (F.col(den) if isinstance(den, str) else den).cast(WHOLE)
    scale = F.lit(10 ** digits).cast("decimal(10,0)")
    # ``div`` divides the decimals as whole numbers; half the divisor more rounds half-up.
    quotient = F.call_function("div", (2 * n * scale + d).cast("decimal(38,0)"), (2 * d).cast("decimal(38,0)"))
    return F.when(d > 0, quotient).cast("double") / F.lit(float(10 ** digits))
