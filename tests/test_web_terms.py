"""The end-to-end web-text job counts the same hits as the operators."""

import os
import tempfile

from pyspark.sql import functions as F

from tidepool.functions import text as tx
from tidepool.operators import terms
from tidepool.plans import fixtures as fx
from tidepool.plans.web_terms import build_web_terms
from tidepool.sources import io

from .conftest import SF_SMALL


def test_web_terms_job(spark):
    t = fx.Tables(spark, SF_SMALL)
    out = tempfile.mkdtemp(prefix="tidepool-web-", dir="/tmp")
    src = os.path.join(out, "corpus")
    fx.web(t).select("url", "text").write.json(src)
    dictionary = fx.dict_a(t)
    paths = build_web_terms(io.read_corpus(spark, src), dictionary, os.path.join(out, "job"),
                            stop_words=fx.WEB_STOP_WORDS, ngram_sizes=(1,), top=5)
    got = {r.term: (r.pages, r.occurrences) for r in spark.read.parquet(paths["term_counts"]).collect()}
    words = tx.remove_stop_words(tx.plain_words("text"), fx.WEB_STOP_WORDS)
    toks = fx.web(t).select("url", F.explode(words).alias("w"))
    want = {r.term: (r.pages, r.occurrences)
            for r in terms.term_counts(terms.term_hits(toks, dictionary), "term", doc="url").collect()}
    assert got == want and got
    top = io.read_table(spark, paths["top_terms"], "csv",
                        "term string, label string, pages long, occurrences long")
    assert top.count() == 5
    assert top.agg(F.max("occurrences")).first()[0] == max(v[1] for v in want.values())
    assert spark.read.parquet(paths["label_counts"]).count() == 2
