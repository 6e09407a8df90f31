"""Taxon classification from occurrence records, crosstabs, name parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.functions.scalars import epithet, genus


def classify_taxa(occ: DataFrame, taxon: str = "taxon", nonmarine: str = "nonmarine",
                  outside_eez: str = "outside_eez", country_like: Sequence[str] = ()) -> DataFrame:
    """Per taxon: marine only, ABNJ, ABNJ only, and its occurrence count.

    * marine only: no record in a non-marine environment;
    * ABNJ: any record outside national jurisdiction;
    * ABNJ only: every record outside it and (when given) no country-like
      field set on any record.
    Each clause is its own column; one grouped pass, partially aggregated.
    """
    abnj_only = F.bool_and(outside_eez)
    if country_like:
        any_country = F.bool_or(F.greatest(*[F.col(c).isNotNull() for c in country_like])) \
            if len(country_like) > 1 else F.bool_or(F.col(country_like[0]).isNotNull())
        abnj_only = abnj_only & ~any_country
    return occ.groupBy(taxon).agg(
        (~F.bool_or(nonmarine)).alias("marine_only"),
        F.bool_or(outside_eez).alias("abnj"),
        abnj_only.alias("abnj_only"),
        F.count(F.lit(1)).alias("occurrences"),
    )


def habitat_crosstab(taxa: DataFrame, by: str,
                     flags: Sequence[str] = ("marine_only", "abnj", "abnj_only")) -> DataFrame:
    """Taxa per group and how many carry each flag (a taxon counts in several
    columns, so these are conditional counts, not a pivot)."""
    return taxa.groupBy(by).agg(F.count(F.lit(1)).alias("taxa"),
                                *[F.count_if(F.col(f)).alias(f) for f in flags])


def rank_habitats(occ: DataFrame, taxon: str = "taxon", rank: str = "rank",
                  habitats: Sequence[str] = ("marine", "brackish", "freshwater", "terrestrial")) -> DataFrame:
    """Taxa per rank, by habitat: one column each, and ``<first habitat>_only``.

    A taxon has a habitat if any of its records does, and counts in each of
    its columns; it is of the first habitat only if it has that and none of the
    others. Two combined aggregates: records to taxa, taxa to ranks.
    """
    flags = occ.groupBy(rank, taxon).agg(*[F.coalesce(F.bool_or(h), F.lit(False)).alias(h) for h in habitats])
    only = F.col(habitats[0])
    for h in habitats[1:]:
        only = only & ~F.col(h)
    return flags.groupBy(rank).agg(F.count(F.lit(1)).alias("taxa"), *[F.count_if(h).alias(h) for h in habitats],
                                   F.count_if(only).alias(f"{habitats[0]}_only"))


def extract_binomial(df: DataFrame, name: str, out: tuple[str, str] = ("genus", "epithet")) -> DataFrame:
    """Split a raw name into its first word (genus) and second word (epithet)."""
    return df.withColumn(out[0], genus(name)).withColumn(out[1], epithet(name))
