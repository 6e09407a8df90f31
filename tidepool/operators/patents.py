"""Patent statistics: first filings, family members, three-way counts, claims."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def within_period(df: DataFrame, date_col: str, start: str, end: str) -> DataFrame:
    """Rows dated in [start, end) (ISO dates); a plain range predicate that
    Parquet min/max statistics can prune on."""
    c = F.col(date_col)
    return df.where((c >= F.lit(start).cast("timestamp_ntz")) & (c < F.lit(end).cast("timestamp_ntz")))


def first_filings(df: DataFrame, family: str = "family_id", filing_date: str = "filing_date",
                  by: Sequence[str] = ()) -> DataFrame:
    """Families by the year of their earliest filing (supply-side count).

    The earliest date is the family's own, whatever ``by``: with ``by`` (e.g.
    applicant, technology area, country) a family counts once in each of its
    groups, always in the year of its first filing.
    """
    first = df.groupBy(family).agg(F.min(filing_date).alias("_first"))
    if by:
        groups = df.select(F.col(family).alias("_family"), *by).distinct()
        first = first.join(groups, first[family].eqNullSafe(groups["_family"]))
    return first.groupBy(F.year("_first").alias("first_year"), *by).agg(F.count(F.lit(1)).alias("families"))


def family_members(df: DataFrame, year: str = "pub_year", country: str = "country",
                   pub: str = "pub_id") -> DataFrame:
    """Distinct publications per publication year and country (demand side)."""
    return df.groupBy(year, country).agg(F.countDistinct(pub).alias("members"))


def family_size(df: DataFrame, family: str = "family_id", pub: str = "pub_id") -> DataFrame:
    """Publications per family."""
    return df.groupBy(family).agg(F.countDistinct(pub).alias("members"))


def three_way_counts(df: DataFrame, by: str = "country", family: str = "family_id",
                     appln: str = "appln_id", pub: str = "pub_id", nested: bool = False) -> DataFrame:
    """Distinct families, applications and publications per group.

    Default: three distinct counts in one aggregate (Spark expands each row
    three times, then de-duplicates). ``nested=True`` uses the hierarchy
    instead, valid when every publication belongs to one application and
    every application to one family: one distinct pass, then counts summed
    up the levels, with no row expansion.
    """
    if not nested:
        return df.groupBy(by).agg(F.countDistinct(family).alias("families"),
                                  F.countDistinct(appln).alias("applications"),
                                  F.countDistinct(pub).alias("publications"))
    links = df.select(by, family, appln, pub).where(F.col(pub).isNotNull()).distinct()
    per_appln = links.groupBy(by, family, appln).agg(F.count(F.lit(1)).alias("_pubs"))
    per_family = per_appln.groupBy(by, family).agg(F.count(F.lit(1)).alias("_applns"),
                                                   F.sum("_pubs").alias("_pubs"))
    return per_family.groupBy(by).agg(F.count(F.lit(1)).alias("families"),
                                      F.sum("_applns").cast("bigint").alias("applications"),
                                      F.sum("_pubs").cast("bigint").alias("publications"))


def claims_vs_text(df: DataFrame, by: str = "country", pub: str = "pub_id", section: str = "section",
                   claims: str = "claims", exclude_col: str | None = None,
                   exclude: Sequence[str] = ()) -> DataFrame:
    """Publications naming the subject in the claims vs anywhere in the text.

    Rows whose ``exclude_col`` is listed in ``exclude`` (e.g. individual
    applicants) are dropped first; NULL there is kept.
    """
    d = df
    if exclude_col and exclude:
        d = d.where(~F.col(exclude_col).isin(*exclude) | F.col(exclude_col).isNull())
    per = d.groupBy(by, pub).agg(F.max((F.col(section) == claims).cast("int")).alias("_in"))
    return per.where(F.col(pub).isNotNull()).groupBy(by).agg(F.sum(F.coalesce("_in", F.lit(0))).cast("bigint").alias("in_claims"),
                                                             F.count(F.lit(1)).alias("anywhere"))
