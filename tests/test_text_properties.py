"""Text primitives against plain Python on random strings (hypothesis)."""

import re
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidepool.functions import text as tx
from tidepool.operators import text

SETTINGS = settings(max_examples=10, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

words = st.sampled_from(["Sea", "reef", "the", "a", "Fish.", "net,", "", "deep", "OCEAN"])
texts = st.lists(words, min_size=0, max_size=12).map(" ".join)
separators = st.sampled_from([" ", "  ", ". ", "! ", "\n", "?  ", "\n\n"])


@SETTINGS
@given(st.lists(texts, min_size=1, max_size=6))
def test_unigrams_match_python(spark, docs):
    df = spark.createDataFrame(list(enumerate(docs)), "page_id long, text string")
    stop = {"the", "a"}
    got = Counter((r.page_id, r.ngram) for r in text.unigrams(df, keep=["page_id"], stop_words=stop).collect())
    want = Counter((i, w) for i, d in enumerate(docs) for w in d.lower().split(" ") if w and w not in stop)
    assert got == want


@SETTINGS
@given(st.lists(texts, min_size=1, max_size=6), st.sampled_from([1, 2, 3]))
def test_ngrams_match_python(spark, docs, n):
    df = spark.createDataFrame(list(enumerate(docs)), "page_id long, text string")
    got = Counter((r.page_id, r.ngram) for r in text.ngrams(df, n, keep=["page_id"]).collect())
    want = Counter()
    for i, d in enumerate(docs):
        toks = [w for w in d.lower().split(" ") if w]
        for k in range(len(toks) - n + 1):
            want[(i, " ".join(toks[k:k + n]))] += 1
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(texts, separators), min_size=1, max_size=6))
def test_sentences_match_python(spark, parts):
    doc = "".join(t + s for t, s in parts)
    df = spark.createDataFrame([(1, doc)], "doc_id long, text string")
    got = [(r.sentno, r.sentence) for r in text.sentences(df).collect()]
    pieces = re.split(r"[.!?]+[ ]+|\n+", doc)
    want = [(i, p) for i, p in enumerate(pieces) if p.strip(" ") != ""]
    assert got == want


def test_strip_tags_and_host(spark):
    df = spark.createDataFrame([("<p>Sea <b>life</b></p>\n\t<br/>end", "https://www.sea.org:443/x?y")],
                               "html string, url string")
    r = df.select(tx.strip_tags("html").alias("t"), tx.url_host("url").alias("h")).first()
    assert (r.t, r.h) == ("Sea life end", "www.sea.org")
