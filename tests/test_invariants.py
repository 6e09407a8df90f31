"""Invariants of the analog outputs at sf0.001."""

import pytest
from pyspark.sql import functions as F

from tidepool.plans.analogs import QUERIES

from .conftest import SF_SMALL


def q(spark, name):
    return QUERIES[name](spark, SF_SMALL)


def test_degree_is_twice_edge_weight(spark):
    deg = q(spark, "a07_weighted_degree").agg(F.sum("total_collaborations")).first()[0]
    edges = q(spark, "a04_institution_pairs").agg(F.sum("n")).first()[0]
    assert deg == 2 * edges


def test_edge_weight_at_most_works_of_both_ends(spark):
    e = q(spark, "a04_institution_pairs")
    w = q(spark, "a08_distinct_works")
    j = (e.join(w.withColumnRenamed("name", "item1").withColumnRenamed("works", "w1"), "item1")
         .join(w.withColumnRenamed("name", "item2").withColumnRenamed("works", "w2"), "item2"))
    assert j.where((F.col("n") > F.col("w1")) | (F.col("n") > F.col("w2"))).count() == 0


def test_pages_at_most_occurrences(spark):
    t = q(spark, "a19_term_counts")
    assert t.where(F.col("pages") > F.col("occurrences")).count() == 0


def test_funnel_never_grows(spark):
    counts = [r.documents for r in q(spark, "a23_funnel").orderBy("stage_no").collect()]
    assert counts == sorted(counts, reverse=True)


def test_level_distribution_sums(spark):
    rows = q(spark, "a26_level_distribution").collect()
    total = [r for r in rows if r.level == "Total"][0].documents
    levels = [r for r in rows if r.level != "Total"]
    assert sum(r.documents for r in levels) == total
    assert max(r.at_least for r in levels) == total


def test_shares_each_at_most_one(spark):
    assert all(0 < r.share <= 1 for r in q(spark, "a27_membership_share").collect())


def test_matched_plus_unmatched(spark):
    assert all(r.matched + r.unmatched == r.documents for r in q(spark, "a30_match_report").collect())


def test_families_applications_publications(spark):
    for r in q(spark, "a38_three_way_counts").collect():
        assert r.families <= r.applications <= r.publications


def test_claims_within_anywhere(spark):
    assert all(r.in_claims <= r.anywhere for r in q(spark, "a39_claims_vs_text").collect())


def test_abnj_only_within_abnj(spark):
    assert q(spark, "a33_classify_taxa").where(F.col("abnj_only") & ~F.col("abnj")).count() == 0


def test_expansion_contains_seeds(spark):
    from pyspark.sql import functions as F
    from tidepool.plans.fixtures import Tables
    got = q(spark, "a42_citation_expand")
    seeds = Tables(spark, SF_SMALL).orders.where(F.col("o_orderpriority") == "1-URGENT") \
        .select(F.col("o_orderkey").alias("work"))
    assert seeds.count() > 0 and seeds.exceptAll(got).count() == 0


@pytest.mark.parametrize("name", ["a15_unigrams", "a49_exclude_terms"])
def test_exclusion_only_removes(spark, name):
    full = {r.ngram: r.n for r in q(spark, "a15_unigrams").collect()}
    part = {r.ngram: r.n for r in q(spark, name).collect()}
    assert all(full[k] >= v for k, v in part.items())


def test_regroup_after_overcounts(spark):
    before = {r.funder: r.works for r in q(spark, "a02_recode_group_works").collect()}
    after = {r.name: r.works for r in q(spark, "a64_funder_table_regroup_after").collect()}
    assert after["GROUP"] >= before["GROUP"]
    assert {k: v for k, v in after.items() if k != "GROUP"} == {k: v for k, v in before.items() if k != "GROUP"}


def test_rescale_spans_bounds(spark):
    r = q(spark, "a10_rescale").agg(F.min("symbol_size"), F.max("symbol_size")).first()
    assert (r[0], r[1]) == (5.0, 100.0)


def test_nested_three_way_counts_equal_distinct(spark):
    from tidepool.operators.patents import three_way_counts
    from tidepool.plans import fixtures as fx
    p = fx.patents(fx.Tables(spark, SF_SMALL))
    a = sorted(tuple(r) for r in three_way_counts(p).collect())
    b = sorted(tuple(r) for r in three_way_counts(p, nested=True).collect())
    assert a == b
