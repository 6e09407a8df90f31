"""Plan shape: what would hurt at scale must not appear."""

import pytest
from pyspark.sql import functions as F

from tidepool.plans.analogs import QUERIES
from tidepool.plans.verify import plan_text

from .conftest import SF_SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


# Windows over a single partition are allowed only on inputs with a proven
# bound: a26 runs its cumulative sum over one row per score level; a84 fills down
# a whole file as one group, whose top carry level has one row for each 65,536
# rows (and levels are added until those are at most as many).
BOUNDED_GLOBAL_WINDOWS = {"a26_level_distribution", "a84_file_order"}


def _global_windows(plan: str) -> int:
    lines = plan.splitlines()
    n = 0
    for i, line in enumerate(lines):
        if "Window [" in line and any("Exchange SinglePartition" in nxt for nxt in lines[i + 1:i + 4]):
            n += 1
    return n


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_shape(spark, name):
    """No cross join, no nested loop, no Python; single-partition windows only
    where their input is bounded."""
    plan = plan_text(QUERIES[name](spark, SF_SMALL), mode="simple")
    for node in FORBIDDEN:
        assert node not in plan, f"{name}: {node}"
    expected = 1 if name in BOUNDED_GLOBAL_WINDOWS else 0
    assert _global_windows(plan) == expected, name


@pytest.mark.parametrize("name", ["a19_term_counts", "a22_cooccurring_documents",
                                  "a24_term_density", "a46_applicant_domain_hits"])
def test_dictionary_match_is_broadcast(spark, name):
    plan = plan_text(QUERIES[name](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan


def test_seed_filter_reaches_the_scan(spark, monkeypatch):
    from tidepool.operators import corpus
    written = []
    monkeypatch.setattr(corpus, "materialize", lambda df, keep=corpus.materialize: (written.append(plan_text(df)), keep(df))[1])
    plan = plan_text(QUERIES["a42_citation_expand"](spark, SF_SMALL))
    assert "EqualTo(o_orderpriority,1-URGENT)" in written[0]
    assert plan.count("lineitem.parquet") == 1  # the edges are read once


def test_scan_reads_only_needed_columns(spark):
    plan = plan_text(QUERIES["a48_sum_numeric"](spark, SF_SMALL))
    assert "ReadSchema: struct<p_partkey:bigint,p_brand:string,p_size:int,p_retailprice:double>" in plan
    plan = plan_text(QUERIES["a17_host_counts"](spark, SF_SMALL))
    assert "ReadSchema: struct<page_id:bigint,url:string>" in plan


def test_pair_self_join_shuffles_once(spark):
    """Both sides of the pair join read one exchange by feature (the final plan, after it ran)."""
    from tidepool.operators import network as net
    df = spark.createDataFrame([(f"i{k % 40}", k // 3) for k in range(600)], "item string, feature long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pairs = net.cooccurrence(df, "item", "feature")
        pairs.collect()
        plan = plan_text(pairs, mode="simple").split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(_feat") - plan.count("ReusedExchange") <= 1, plan
    assert "ReusedExchange" in plan


@pytest.mark.parametrize("name", ["a01_disambiguate_names", "a04_institution_pairs", "a07_weighted_degree", "a09_entity_table",
                                  "a11_graph_nodes", "a12_graph_links", "a14_ego_network", "a71_graph_elements"])
def test_the_largest_table_is_read_once(spark, name, monkeypatch):
    """Reads of lineitem: one while the links are written, none in the plan that is returned."""
    from tidepool.plans import fixtures
    written = []
    monkeypatch.setattr(fixtures, "materialize", lambda df, keep=fixtures.materialize: (written.append(plan_text(df)), keep(df))[1])
    plan = plan_text(QUERIES[name](spark, SF_SMALL))
    assert "lineitem" not in plan
    assert sum("lineitem" in p for p in written) == 1


def test_period_cut_reaches_the_scan(spark):
    plan = plan_text(QUERIES["a60_period_filings"](spark, SF_SMALL))
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01T00:00)" in plan
    assert "LessThan(o_orderdate,2000-01-01T00:00)" in plan


# ---- bounded tasks --------------------------------------------------------------

def _documents(spark, folder):
    """Documents with repeated and null keys and texts, as the tables of a folder."""
    from tidepool.plans.fixtures import Tables
    rows = [(1, "a b a", "en"), (1, "b c", "de"), (2, None, "en"), (None, "a", "en"), (3, " d  d ", None), (4, "", "de"), (5, "a B", "de"), (6, "z", "de")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{folder}/documents.parquet")
    return Tables(spark, str(folder))


def test_words_are_made_after_documents_have_met(spark, tmp_path):
    """Neither a join nor a shuffle moves words, and distinct links of a document's words need no shuffle more."""
    from tidepool.plans import fixtures as fx
    t = _documents(spark, tmp_path)
    toks = fx.dtok_with(t, "lang")
    want = fx.dtok(t).join(t.documents.select("doc_id", "lang"), "doc_id")
    assert toks.columns == want.columns and sorted(map(str, toks.collect())) == sorted(map(str, want.collect()))
    plan = plan_text(toks.distinct(), mode="simple")
    above = plan[:plan.index("Generate")]
    assert "Join" not in above and "Exchange" not in above, plan


def test_parts_grow_with_the_weight(spark):
    from tidepool.session import dealt_by_weight
    df = spark.range(1000).selectExpr("id % 100 AS k", "id")
    few, many = spark.sparkContext.defaultParallelism, 50
    assert dealt_by_weight(df, F.lit(2), 40, "k").rdd.getNumPartitions() == many
    assert dealt_by_weight(df, F.lit(2), 10_000, "k").rdd.getNumPartitions() == few
    assert dealt_by_weight(df.where("false"), F.lit(2), 40, "k").rdd.getNumPartitions() == few


def test_compared_works_make_links_distinct_where_they_lie(spark, tmp_path, monkeypatch):
    from tidepool.operators import corpus
    from tidepool.plans import fixtures as fx
    plans, write = [], corpus.materialize
    monkeypatch.setattr(corpus, "materialize", lambda df: plans.append(plan_text(df, mode="simple")) or write(df))
    got = {r.membership: (r.terms, r.works) for r in corpus.compare_works(fx.dtok_with(_documents(spark, tmp_path), "lang"), "w", "lang", "doc_id", "en", "de").collect()}
    assert got == {"both": (3, 2), "de_only": (1, 1)}
    assert "Exchange" not in plans[0][:plans[0].index("Generate")], plans[0]


def test_multiplied_hits_are_not_shuffled(spark):
    """A hit's ancestors travel as one list; rows for each are made and counted where a document's hits have met."""
    from tidepool.operators import hierarchy
    hits = spark.createDataFrame([(d, d % 16) for d in range(64)], "doc_id long, term long")
    closure = spark.createDataFrame([(n, a) for n in range(16) for a in (n + 16, 99)], "node long, ancestor long")
    df = hierarchy.rollup_counts(hits, closure)
    above = (plan := plan_text(df, mode="simple"))[:plan.index("Generate")]
    assert above.count("Exchange") == 1, plan  # of the counts per term
    got = {r.term: (r.own, r.documents) for r in df.collect()}
    assert got == {**{n: (4, 4) for n in range(16)}, **{n + 16: (0, 4) for n in range(16)}, 99: (0, 64)}
