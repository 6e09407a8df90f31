"""Equivalence classes, hierarchies, phrases, exact quantiles, plurals, sketches."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidepool.operators import components, corpus, hierarchy, phrases, select, terms


def plain_components(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in list(parent)}


def chain(n, order):
    ids = list(range(n))
    if order == "mixed":
        random.Random(3).shuffle(ids)
    return [(ids[i], ids[i + 1]) for i in range(n - 1)]


@pytest.mark.parametrize("edges", [
    chain(60, "straight"), chain(60, "mixed"),                                   # long chains
    [(0, i) for i in range(1, 400)] + [(1000 + i, 1000 + i + 1) for i in range(0, 800, 2)] + [(7, 2000)],   # a hub with a third of all rows
    [(5, 5), (6, 7), (7, 6), (6, 7), (None, 3), (4, None)],                       # loops, repeats, NULL ends
    [(random.Random(1).randrange(0, 300), i) for i in range(300)] + [(i * 7 % 300, i * 13 % 300) for i in range(90)]])
def test_components_match_a_plain_version(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long").repartition(4)
    got = {r.node: r.root for r in components.connected_components(df).collect()}
    assert got == plain_components([e for e in edges if None not in e])


def test_components_of_nothing(spark):
    assert components.connected_components(spark.createDataFrame([], "a string, b string")).count() == 0


def test_variants_get_one_id_and_name(spark):
    records = [("geo", str(i), n) for i in range(13) for n in (f"n{i:02}", f"n{i + 1:02}")]     # a chain of 14 names
    records += [("geo", "90", "Dogger Bank"), ("who", "4", "dogger"), ("who", "4", "Dogger Bank"), ("geo", "90", "Dogger Bank"),
                ("geo", "91", "Dogger Bank"), ("geo", None, "lost"), ("geo", "92", None), ("geo", "93", "alone")]
    got = {r.name: (r.place_id, r.canonical) for r in
           components.variant_classes(spark.createDataFrame(records, "source string, id string, name string")).collect()}
    assert {got[f"n{i:02}"] for i in range(14)} == {("geo\x1f0", "n01")}
    assert got["dogger"] == got["Dogger Bank"] == ("geo\x1f90", "Dogger Bank")
    assert got["alone"] == ("geo\x1f93", "alone") and "lost" not in got


# ---- hierarchies --------------------------------------------------------------

def test_ancestors_of_chains_and_lattices(spark):
    edges = [(f"c{i}", f"c{i + 1}") for i in range(25)] + [("a", "b"), ("a", "x"), ("b", "top"), ("x", "top"), ("z", "z"), (None, "a"), ("q", None)]
    got = {(r.node, r.ancestor) for r in hierarchy.ancestor_closure(spark.createDataFrame(edges, "child string, parent string")).collect()}
    want = {(f"c{i}", f"c{j}") for i in range(25) for j in range(i + 1, 26)} | {("a", "b"), ("a", "x"), ("a", "top"), ("b", "top"), ("x", "top")}
    assert got == want


@pytest.mark.parametrize("n", [2, 3, 8])
def test_a_cycle_raises(spark, n):
    edges = [(i, (i + 1) % n) for i in range(n)] + [(100, 0)]
    with pytest.raises(ValueError, match="cycle"):
        hierarchy.ancestor_closure(spark.createDataFrame(edges, "child long, parent long"))


def test_documents_count_once_on_each_level(spark):
    closure = hierarchy.ancestor_closure(spark.createDataFrame([("bay", "sea"), ("gulf", "sea"), ("sea", "ocean")], "child string, parent string"))
    hits = spark.createDataFrame([(1, "bay"), (1, "gulf"), (1, "bay"), (2, "sea"), (2, "bay"), (3, "ocean"), (4, "pond"), (None, "bay"), (5, None)],
                                 "doc_id long, term string")
    got = {r.term: (r.own, r.documents) for r in hierarchy.rollup_counts(hits, closure).collect()}
    assert got == {"bay": (2, 2), "gulf": (1, 1), "sea": (1, 2), "ocean": (1, 3), "pond": (1, 1)}


# ---- phrases --------------------------------------------------------------------

def plain_hits(texts, dictionary):
    import re
    out = []
    for doc, text in texts:
        words = [w for w in (re.sub(r"^[^\w]+|[^\w]+$", "", x) for x in re.split(r"[ \t\r\n]+", (text or "").lower())) if w]
        for i in range(len(words)):
            out += [(doc, t, i, len(t.split(" "))) for t in dictionary if words[i:i + len(t.split(" "))] == t.split(" ")]
    return out


def plain_taken(hits):
    by, out = defaultdict(dict), []
    for doc, t, i, n in hits:
        if n > by[doc].get(i, (None, 0))[1]:
            by[doc][i] = (t, n)
    for doc, at in by.items():
        end = 0
        for i in sorted(at):
            if i >= end:
                out.append((doc, at[i][0], i, at[i][1]))
                end = i + at[i][1]
    return out


DICTIONARY = ["sea", "deep sea", "deep sea vent", "sea vent crab", "vent crab of the deep sea", "the", "a a", "a a a", "crab"]


def test_phrases_of_any_length(spark):
    r = random.Random(5)
    words = "deep sea vent crab of the a".split()
    texts = [(i, " ".join(r.choice(words) for _ in range(r.randrange(0, 60)))) for i in range(40)]
    texts += [(90, None), (91, ""), (92, " . "), (93, "The (deep) sea, vent crab of the deep sea."), (94, "a " * 700), (95, "deep sea")]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    d = spark.createDataFrame([(t,) for t in DICTIONARY] + [("sea",), ("",), (None,)], "term string")
    hits = phrases.phrase_hits(df, d)
    want = plain_hits(texts, DICTIONARY)
    assert Counter(tuple(x) for x in hits.select("doc_id", "term", "at", "size").collect()) == Counter(want)
    taken = phrases.leftmost_longest(hits)
    assert sorted(tuple(x) for x in taken.select("doc_id", "term", "at", "size").collect()) == sorted(plain_taken(want))


def test_phrases_by_a_shuffle_are_the_same(spark, monkeypatch):
    df = spark.createDataFrame([(1, "deep sea vent the deep sea"), (2, "the the the")], "doc_id long, text string")
    d = spark.createDataFrame([(t,) for t in DICTIONARY], "term string")
    want = sorted(map(tuple, phrases.phrase_hits(df, d).collect()))
    monkeypatch.setattr(phrases, "bounded_broadcast", lambda side, **kw: side)
    assert sorted(map(tuple, phrases.phrase_hits(df, d).collect())) == want


def test_no_phrase_is_exploded(spark):
    from tidepool.plans.verify import plan_text
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = plan_text(phrases.phrase_hits(df, spark.createDataFrame([("b c d e f",)], "term string")), mode="simple")
    # Stretches of a text, words, and a word with the next; nothing for the other lengths.
    assert plan.count("Generate") == 3 and "Exchange hashpartitioning" not in plan


# ---- quantiles --------------------------------------------------------------------

@pytest.mark.parametrize("values", [
    [3], [1, 2], [5, 5, 5, 5], [1, 9, 2, 8, 3], list(range(1000)), [7] * 400 + list(range(800)), [-5.5, 2.25, None, 1e18, float("nan"), -1e18],
    [2 ** 62, 2 ** 62 + 1, 2 ** 62 + 2, 2 ** 62 + 3], [0.1 * i * i for i in range(500)] + [1e9]])
@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.9, 1.0])
def test_exact_quantiles(spark, values, q):
    kind = "double" if any(isinstance(v, float) for v in values) else "long"
    df = spark.createDataFrame([(float(v) if kind == "double" and v is not None else v,) for v in values], f"v {kind}")
    want = df.where("v IS NOT NULL AND NOT isnan(double(v))").select(F.percentile("v", q)).first()[0]
    for bins, most in ((4, 3), (1024, 65_536)):
        assert select.exact_quantile(df, "v", q, bins=bins, most=most) == pytest.approx(want, rel=1e-15)


def test_a_quantile_of_nothing(spark):
    assert select.exact_quantile(spark.createDataFrame([(None,)], "v double"), "v") is None


# ---- plurals, sketches -------------------------------------------------------------

def test_plurals_need_their_singular_in_the_corpus(spark):
    words = "fish fishes bus buses glass glasses body bodies species specie cat cats dogs axis axes boxes box gas s es as".split()
    got = {r.variant: r.canonical for r in terms.singular_map(spark.createDataFrame([(w,) for w in words] + [(None,)], "w string")).collect()}
    assert got == {"fishes": "fish", "glasses": "glass", "bodies": "body", "species": "specie", "cats": "cat", "boxes": "box"}


def test_sketches_merge_to_what_one_sketch_says(spark):
    rows = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("g"), (F.col("id") % 7).alias("part"),
                                      (F.col("id") % 20_000).cast("string").alias("w"))
    once = corpus.sketch_corpora(rows, "g", {"terms": "w"})
    merged = corpus.merge_sketches(corpus.sketch_corpora(rows, "g", {"terms": "w"}, snapshot="part"))
    exact = {r.membership: r.terms for r in corpus.compare_groups(rows, "w", "g", "a", "b").collect()}
    for s in (once, merged):
        got = {r.membership: (r.estimate, r.bound) for r in corpus.compare_sketches(s, "a", "b").collect()}
        for part, n in exact.items():
            assert abs(got[part][0] - n) <= got[part][1], part
        assert abs(got["either"][0] - sum(exact.values())) <= got["either"][1]


def test_sketches_of_a_corpus_that_is_not_there(spark):
    rows = spark.createDataFrame([("a", "x"), ("a", "y")], "g string, w string")
    got = {r.membership: r.estimate for r in corpus.compare_sketches(corpus.sketch_corpora(rows, "g", {"terms": "w"}), "a", "b").collect()}
    assert got == {"both": 0, "a_only": 2, "b_only": 0, "either": 2}
