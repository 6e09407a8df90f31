"""Edge cases named in the survey's test strategy."""

import pytest
from pyspark.sql import functions as F

from tidepool.functions import text as tx
from tidepool.operators import network as net
from tidepool.operators import text
from tidepool.operators.clean import assert_unique, crosswalk, recode


def test_null_items_and_dashes(spark):
    df = spark.createDataFrame([("a-b", "w"), ("a", "w"), (None, "w"), ("b-", "w")],
                               "item string, feature string")
    got = {(r.item1, r.item2) for r in net.cooccurrence(df, "item", "feature").collect()}
    assert got == {("a", "a-b"), ("a", "b-"), ("a-b", "b-")}


def test_undirected_keeps_dash_names_apart(spark):
    e = spark.createDataFrame([("a-b", "c", 1), ("c", "a-b", 1), ("a", "b-c", 2)], "s string, t string, n int")
    assert net.undirected(e, "s", "t", "n").count() == 2


def test_empty_text_and_double_blanks(spark):
    df = spark.createDataFrame([(1, ""), (2, "Sea  Water"), (3, None)], "id int, text string")
    toks = text.unigrams(df, keep=["id"]).collect()
    assert [(r.id, r.ngram) for r in toks] == [(2, "sea"), (2, "water")]
    raw = text.unigrams(df, keep=["id"], pattern=r"\s", drop_empty=False).where("id = 2").collect()
    assert [r.ngram for r in raw] == ["sea", "", "water"]


def test_text_shorter_than_n(spark):
    df = spark.createDataFrame([(1, "one"), (2, "one two"), (3, "")], "id int, text string")
    got = [(r.id, r.ngram) for r in text.ngrams(df, 2, keep=["id"]).collect()]
    assert got == [(2, "one two")]
    assert text.ngrams(df, 3, keep=["id"]).count() == 0


def test_url_hosts(spark):
    df = spark.createDataFrame([("http://www.a.org:8080/x",), ("https://b.net?q=1",), ("not a url",), (None,),
                                ("HTTP://A.org/x",), ("http://user:pw@h.org/",), ("ftp+x://u@k.de#f",)],
                               "url string")
    got = [r.h for r in df.select(tx.url_host("url").alias("h")).collect()]
    assert got == ["www.a.org", "b.net", None, None, "A.org", "h.org", "k.de"]
    parsed = [r.h for r in df.select(tx.url_host("url", exact_regex=False).alias("h")).collect()]
    assert parsed[0] == "www.a.org" and parsed[2] is None


def test_english_stop_words(spark):
    words = text.english_stop_words()
    assert "the" in words and len(words) > 100


def test_recode_and_default(spark):
    df = spark.createDataFrame([("XK",), ("FR",), (None,)], "cc string")
    got = [r.cc for r in recode(df, "cc", {"XK": "XKX"}).collect()]
    assert got == ["XKX", "FR", None]
    got = [r.out for r in recode(df, "cc", {"XK": "XKX"}, out="out", default="Unclassified").collect()]
    assert got == ["XKX", "Unclassified", "Unclassified"]


def test_crosswalk_fixes_and_missing(spark):
    codes = spark.createDataFrame([("FR",), ("RE",), ("ZZ",)], "cc string")
    lk = spark.createDataFrame([("FR", "France"), ("RE", "Reunion")], "code string, economy string")
    got = {r.cc: r.label for r in crosswalk(codes, "cc", lk, "code", "economy",
                                             fixes={"RE": "France"}).collect()}
    assert got == {"FR": "France", "RE": "France", "ZZ": "Unclassified"}


def test_duplicated_lookup_key_raises(spark):
    lk = spark.createDataFrame([("A", 1), ("A", 2)], "k string, v int")
    with pytest.raises(ValueError):
        assert_unique(lk, "k")


def test_one_row_group_and_sentences(spark):
    df = spark.createDataFrame([(1, "One. Two!  Three\n\nFour"), (2, "   ")], "doc_id int, text string")
    got = [(r.doc_id, r.sentno, r.sentence) for r in text.sentences(df).collect()]
    assert got == [(1, 0, "One"), (1, 1, "Two"), (1, 2, "Three"), (1, 3, "Four")]


def test_enrich_never_multiplies(spark):
    from tidepool.operators.clean import enrich
    probe = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    details = spark.createDataFrame([(1, 5, "late"), (1, 2, "early"), (3, 1, "other")], "dk int, o int, d string")
    got = sorted((r.k, r.d) for r in enrich(probe, details, "k", "dk", ["o"]).collect())
    assert got == [(1, "early"), (2, None)]


def test_variant_map_and_canonicalize(spark):
    from tidepool.operators import terms
    d = spark.createDataFrame([("sea",), ("sea.",), ("sea,,",), ("reef",)], "term string")
    m = {(r.variant, r.canonical) for r in terms.variant_map(d).collect()}
    assert m == {("sea.", "sea"), ("sea,,", "sea")}
    hits = spark.createDataFrame([(1, "sea."), (2, "reef"), (3, "sea")], "page_id int, term string")
    got = sorted(r.term for r in terms.canonicalize(hits, terms.variant_map(d)).collect())
    assert got == ["reef", "sea", "sea"]


def test_within_period_is_half_open(spark):
    from tidepool.operators.patents import within_period
    df = spark.sql("SELECT explode(array(TIMESTAMP_NTZ'1995-12-31 23:59:59', TIMESTAMP_NTZ'1996-01-01 00:00:00', "
                   "TIMESTAMP_NTZ'1999-12-31 00:00:00', TIMESTAMP_NTZ'2000-01-01 00:00:00')) AS d")
    assert within_period(df, "d", "1996-01-01", "2000-01-01").count() == 2


def test_approximate_distinct_counts_close(spark):
    from pyspark.sql import functions as F
    df = spark.range(20000).select((F.col("id") % 3).cast("string").alias("k"), F.col("id").alias("v"))
    exact = {r.name: r.works for r in net.distinct_counts(df, "k", "v").collect()}
    approx = {r.name: r.works for r in net.distinct_counts(df, "k", "v", approx_rsd=0.02).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(approx[k] - exact[k]) <= 0.08 * exact[k] for k in exact)
    g = df.select(F.col("k").alias("ngram"), F.col("v").alias("page_id"))
    assert {r.ngram: r.n for r in text.ngram_counts(g, approx_rsd=0.02).collect()} == \
        {r.ngram: r.n for r in text.ngram_counts(g).collect()}


def test_survey_operator_names(spark):
    from tidepool.operators import rank, terms
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", 3)], "k string, id int")
    assert {r.name: r.works for r in rank.distinct_works(df, "k", "id").collect()} == {"a": 2, "b": 1}
    toks = spark.createDataFrame([(1, "sea"), (1, "reef"), (2, "sea")], "page_id int, w string")
    da = spark.createDataFrame([("sea",)], "term string")
    db = spark.createDataFrame([("reef",)], "term string")
    assert [r.page_id for r in terms.cooccurring_pages(toks, da, db).collect()] == [1]


def test_crosswalk_rejects_duplicated_lookup(spark):
    codes = spark.createDataFrame([("FR",)], "cc string")
    lk = spark.createDataFrame([("FR", "France"), ("FR", "Francia")], "code string, economy string")
    with pytest.raises(ValueError):
        crosswalk(codes, "cc", lk, "code", "economy")


def test_count_ratio_rounds_ties_half_up_exactly(spark):
    from tidepool.functions.scalars import count_ratio
    df = spark.createDataFrame([(41, 640), (1, 3), (2, 3), (0, 5), (7, 0), (1, 8000000)], "n long, d long")
    got = [r.q for r in df.select(count_ratio("n", "d").alias("q")).collect()]
    assert got == [0.064063, 0.333333, 0.666667, 0.0, None, 0.0]


def test_rescale_rounds_exactly(spark):
    df = spark.createDataFrame([(0,), (1,), (128,)], "v long")
    got = sorted(r.symbol_size for r in net.rescale(df, "v", (5.0, 100.0), digits=6).collect())
    assert got == [5.0, 5.742188, 100.0]            # 5 + 95/128 = 5.7421875, a tie
    flat = spark.createDataFrame([(3,), (3,)], "v long")
    assert {r.symbol_size for r in net.rescale(flat, "v", digits=6).collect()} == {52.5}
    dbl = spark.createDataFrame([(0.0,), (0.5,), (2.0,)], "v double")
    assert sorted(r.symbol_size for r in net.rescale(dbl, "v", digits=6).collect()) == [5.0, 28.75, 100.0]


def test_graph_nodes_approximate_median(spark):
    ents = spark.range(1, 1001).selectExpr("CAST(id AS STRING) AS name", "'c' AS category", "id AS works")
    exact = net.graph_nodes(ents, "name", "category", "works", threshold="median").count()
    approx = net.graph_nodes(ents, "name", "category", "works", threshold="median_approx").count()
    assert exact == 500 and abs(approx - exact) <= 5


def test_fill_down_is_the_same_for_any_block_size(spark):
    from tidepool.operators.clean import fill_down
    rows = [(g, k, "v%d" % k if k % 7 == 0 else None) for g in ("a", None, "b") for k in range(3, 60)]
    df = spark.createDataFrame(rows, "g string, k long, v string")
    want = None
    for chunk in (2, 5, 1 << 16):
        got = sorted(map(tuple, fill_down(df, "v", "g", "k", chunk=chunk).select("g", "k", "v").collect()), key=repr)
        want = want or got
        assert got == want
    assert (None, 59, "v56") in want and ("a", 6, None) in want


def test_ratios_are_exact_for_large_counts(spark):
    import random
    from fractions import Fraction

    from tidepool.functions.scalars import count_ratio, rescale_column
    r = random.Random(4)
    rows = [(r.randint(0, 10**18), r.randint(1, 10**18)) for _ in range(300)] + [(41, 640), (5 * 10**12, 5 * 10**12), (1, 0)]
    df = spark.createDataFrame(rows, "n long, d long")

    def half_up(x):
        return float(int(x * 10**6 + Fraction(1, 2))) / 1e6

    got = [x[0] for x in df.select(count_ratio("n", "d")).collect()]
    assert got == [half_up(Fraction(n, d)) if d else None for n, d in rows]
    values = [0, 60_000_000_000, 77_000_000_000, 10**18]
    v = spark.createDataFrame([(x,) for x in values], "v long")
    got = sorted(x[0] for x in v.select(rescale_column(v, "v", 5, 100, 6)).collect())
    assert got == [half_up(5 + 95 * Fraction(x, 10**18)) for x in values]


def test_tokens_with_empty_ones_are_the_ml_tokenizers(spark):
    from pyspark.ml.feature import Tokenizer
    df = spark.createDataFrame([(x,) for x in ("a b  ", "", "  ", " a", "a", "a  b", "A\tb\n\n")], "t string")
    want = [list(r["o"]) for r in Tokenizer(inputCol="t", outputCol="o").transform(df).collect()]
    assert [list(r[0]) for r in df.select(tx.tokenize("t", r"\s", drop_empty=False)).collect()] == want


def test_first_per_key_sorts_missing_last(spark):
    from tidepool.operators.clean import first_per_key
    df = spark.createDataFrame([("a", None, "x"), ("a", 2, "y"), ("a", 3, "z"), ("b", None, "only")], "k string, o int, v string")
    assert sorted(map(tuple, first_per_key(df, "k", ["o"]).collect()), key=repr) == [("a", 2, "y"), ("b", None, "only")]


def test_centroids_of_flat_places(spark):
    from tidepool.operators.places import centroid
    edges = [("flat", 0.0, 0.0, 2.0, 0.0), ("flat", 2.0, 0.0, 0.0, 0.0), ("point", 3.0, 4.0, 3.0, 4.0), ("line", 0.0, 0.0, 0.0, 2.0),
             ("line", 0.0, 2.0, 6.0, 2.0), ("box", 0.0, 0.0, 2.0, 0.0), ("box", 2.0, 0.0, 2.0, 2.0), ("box", 2.0, 2.0, 0.0, 2.0), ("box", 0.0, 2.0, 0.0, 0.0)]
    got = {r["poly_id"]: (r["area"], r["cx"], r["cy"]) for r in centroid(spark.createDataFrame(
        edges, "poly_id string, x1 double, y1 double, x2 double, y2 double")).collect()}
    assert got == {"flat": (0.0, 1.0, 0.0), "point": (0.0, 3.0, 4.0), "line": (0.0, 2.25, 1.75), "box": (4.0, 1.0, 1.0)}


def test_an_unset_shared_folder_is_an_error_off_one_machine():
    import pytest

    from tidepool.session import ensure_checkpoint_dir

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
