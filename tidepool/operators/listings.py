"""Product-listing cascade and applicant-domain page hits."""

from __future__ import annotations

import math
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidepool.functions import text as tx
from tidepool.functions.joins import bounded_broadcast
from tidepool.operators.phrases import phrase_hits
from tidepool.session import dealt_by_weight, materialize


def listing_stages(listings: DataFrame, stop_words: Iterable[str], title: str = "title",
                   term: str = "search_term") -> DataFrame:
    """Flag each listing with the cascade stages it passes.

    * ``kept``: no stop word among the title's whole words;
    * ``any_word``: kept, and shares a word with its search term;
    * ``full_phrase``: any_word, and contains the whole term as a phrase.
    """
    stop = F.array(*[F.lit(w) for w in sorted(set(stop_words))])
    words = tx.word_array(title)
    kept = ~F.arrays_overlap(words, stop)
    any_word = kept & F.arrays_overlap(words, tx.word_array(term))
    phrase = any_word & tx.contains_phrase(title, term)
    return listings.withColumn("kept", kept).withColumn("any_word", any_word) \
        .withColumn("full_phrase", phrase)


def filter_listings(listings: DataFrame, stop_words: Iterable[str], key: str = "asin",
                    title: str = "title", term: str = "search_term") -> DataFrame:
    """Counts through the cascade in one aggregate: all, after stop words,
    distinct listings after stop words, any word, full phrase."""
    s = listing_stages(listings, stop_words, title, term)
    return s.agg(F.count(F.lit(1)).alias("listings"),
                 F.count_if("kept").alias("after_stop_words"),
                 F.countDistinct(F.when(F.col("kept"), F.col(key))).alias("distinct_listings"),
                 F.count_if("any_word").alias("any_word"),
                 F.count_if("full_phrase").alias("full_phrase"))


def applicant_domain_hits(tokens: DataFrame, dictionary: DataFrame, pages: DataFrame | None = None,
                          min_pages: int = 3, host: str = "host", page: str = "page_id",
                          token: str = "w", term: str = "term") -> DataFrame:
    """Pages per (host, term) on hosts with at least ``min_pages`` pages.

    Host page counts come from ``pages`` (all crawled pages of the host) or,
    when not given, from the token rows' own pages; the host filter is a semi
    join, then the dictionary match.
    """
    hosts = ((pages if pages is not None else tokens).groupBy(host).agg(F.countDistinct(page).alias("_pages"))
             .where(F.col("_pages") >= min_pages).select(F.col(host).alias("_h")))
    hosts = bounded_broadcast(hosts)
    t = tokens.join(hosts, tokens[host] == hosts["_h"], "left_semi")
    d = bounded_broadcast(dictionary.select(F.col(term).alias("_term")).distinct())
    hits = t.join(d, t[token] == d["_term"])
    return hits.groupBy(host, F.col("_term").alias("term")).agg(F.countDistinct(page).alias("pages"))


# Terms of a block, one for each bit of a long, and terms that one task numbers at a time.
BLOCK = 64
NUMBERED = 4096
# Blocks of applicants' terms that one task joins with their domains.
NAMED_ROWS = 1 << 18


def _bit(place) -> Column:
    """The long with the one bit ``place``."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.col(place))


def term_blocks(terms: DataFrame, term: str = "term") -> DataFrame:
    """(term, _block, _bit): distinct terms in blocks of at most ``BLOCK``, numbered in as many tasks as there are terms for."""
    each = materialize(terms.select(term).distinct())
    tasks = max(1, math.ceil(each.count() / NUMBERED))
    each = each.withColumn("_part", F.pmod(F.xxhash64(term), F.lit(tasks)))
    number = F.row_number().over(W.partitionBy("_part").orderBy(term)) - 1
    numbered = each.withColumn("_at", number).withColumn("_group", F.floor(F.col("_at") / BLOCK))
    return numbered.select(term, (F.col("_group") * tasks + F.col("_part")).alias("_block"), (F.col("_at") % BLOCK).alias("_bit"))


class SpeciesPages(NamedTuple):
    """Hits of ``applicant_species_pages``, a bit for each.

    ``hits`` (applicant, host, _block, _bits): an applicant's own terms that its
    domain has, a row for a block of terms; ``found`` (host, _block, _found):
    the terms of a block that a host has, with their bits and pages.
    """

    hits: DataFrame
    found: DataFrame
    applicant: str
    host: str
    term: str

    def rows(self) -> DataFrame:
        """(applicant, host, term, pages): a row for each hit."""
        each = self.hits.join(bounded_broadcast(self.found), [self.host, "_block"]).select(self.applicant, self.host, "_bits", F.inline("_found"))
        return each.where(F.getbit("_bits", F.col("_bit")) == 1).select(self.applicant, self.host, self.term, "pages")

    def totals(self) -> DataFrame:
        """(term, applicants, domains, most_pages): distinct applicants and domains with a hit, and the most pages of one domain."""
        anywhere = self.hits.groupBy(self.applicant, "_block").agg(F.bit_or("_bits").alias("_bits"))
        each = anywhere.select("_block", "_bits", F.explode(F.sequence(F.lit(0), F.lit(BLOCK - 1))).alias("_bit"))
        applicants = each.where(F.getbit("_bits", F.col("_bit")) == 1).groupBy("_block", "_bit").agg(F.count(F.lit(1)).alias("applicants"))
        of_host = self.hits.groupBy(self.host, "_block").agg(F.bit_or("_bits").alias("_bits"))
        domains = of_host.join(self.found, [self.host, "_block"]).select("_block", "_bits", F.inline("_found"))
        domains = (domains.where(F.getbit("_bits", F.col("_bit")) == 1).groupBy("_block", "_bit", self.term)
                   .agg(F.count(F.lit(1)).alias("domains"), F.max("pages").alias("most_pages")))
        return domains.join(applicants, ["_block", "_bit"]).select(self.term, "applicants", "domains", "most_pages")


def applicant_species_pages(applicants: DataFrame, species: DataFrame, pages: DataFrame, min_pages: int = 3,
                            applicant: str = "applicant", host: str = "host", page: str = "page_id", text: str = "text",
                            term: str = "term", packed: bool = False) -> DataFrame | SpeciesPages:
    """(applicant, host, term, pages): pages on an applicant's domain that name a species of the applicant's own patents.

    ``applicants`` (applicant, host) and ``species`` (applicant, term) are link
    tables, ``pages`` has a text and a host for each page. Only hosts with at
    least ``min_pages`` pages count. Pages are cut down to the hosts of any
    applicant before their text is read, terms of any applicant are found in
    it, and pages are counted per (host, term) before applicants are joined:
    applicants with one domain share that count.

    The terms found are dealt into blocks, and an applicant's own terms of a
    block are one row of bits, as are a host's: joined, a row holds all hits of
    an applicant on a domain in a block. ``packed`` gives these
    (``SpeciesPages``), which count without a row for each hit.
    """
    own = materialize(applicants.select(applicant, host).distinct())
    hosts = (pages.groupBy(host).agg(F.countDistinct(page).alias("_pages")).where(F.col("_pages") >= min_pages)
             .join(own.select(host).distinct(), host, "left_semi").select(F.col(host).alias("_h")))
    near = pages.join(bounded_broadcast(hosts), F.col(host) == F.col("_h"), "left_semi")
    hits = phrase_hits(near, species.select(term).distinct(), text, [host, page], term).select(host, page, term).distinct()
    counted = materialize(hits.groupBy(host, term).agg(F.count(F.lit(1)).alias("pages")))
    blocks = bounded_broadcast(term_blocks(counted, term))
    found = materialize(counted.join(blocks, term).groupBy(host, "_block").agg(
        F.bit_or(_bit("_bit")).alias("_bits"), F.collect_list(F.struct("_bit", term, "pages")).alias("_found")))
    named = materialize(species.join(blocks, term).groupBy(applicant, "_block").agg(F.bit_or(_bit("_bit")).alias("_named")))
    # Each applicant's terms on each of its domains, kept where that domain has the term.
    spread = dealt_by_weight(named, F.lit(1), NAMED_ROWS, applicant)  # many rows in few bytes: files alone would make few tasks
    met = spread.join(own, applicant).join(bounded_broadcast(found.select(host, "_block", "_bits")), [host, "_block"])
    met = met.withColumn("_bits", F.col("_named").bitwiseAND(F.col("_bits"))).where("_bits != 0")
    out = SpeciesPages(met.select(applicant, host, "_block", "_bits"), found.select(host, "_block", "_found"), applicant, host, term)
    return out if packed else out.rows()


def search_term_match(title: str, term: str, common_name: str):
    """Whether a title shares a word with the search term or with the common name."""
    words = tx.plain_words(title)
    named = F.coalesce(F.arrays_overlap(words, tx.plain_words(common_name)), F.lit(False))
    return F.coalesce(F.arrays_overlap(words, tx.plain_words(term)), F.lit(False)) | named
