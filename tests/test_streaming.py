"""Streaming ingestion equals the batch dictionary match on the same pages."""

import os
import tempfile

from pyspark.sql import functions as F

from tidepool.operators import terms, text
from tidepool.plans import fixtures as fx
from tidepool.streaming.ingest import ingest_term_hits

from .conftest import SF_SMALL


def test_stream_matches_batch(spark):
    t = fx.Tables(spark, SF_SMALL)
    corpus = fx.web(t).select("url", "text")
    scratch = tempfile.mkdtemp(prefix="tidepool-stream-", dir="/tmp")
    src = os.path.join(scratch, "src")
    corpus.repartition(4).write.json(src)
    dictionary = fx.dict_a(t)
    q = ingest_term_hits(spark, src, dictionary, os.path.join(scratch, "sink"),
                         stop_words=fx.WEB_STOP_WORDS, checkpoint=os.path.join(scratch, "ckpt"),
                         max_files_per_trigger=1)
    q.awaitTermination(300)
    got = spark.read.parquet(os.path.join(scratch, "sink")).groupBy("term").count()
    toks = text.unigrams(corpus, "text", keep=["url"], stop_words=fx.WEB_STOP_WORDS, out="w")
    want = terms.term_hits(toks, dictionary).groupBy("term").count()
    assert got.count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    # A restart with the same checkpoint finds nothing new to do.
    q2 = ingest_term_hits(spark, src, dictionary, os.path.join(scratch, "sink"),
                          stop_words=fx.WEB_STOP_WORDS, checkpoint=os.path.join(scratch, "ckpt"))
    q2.awaitTermination(300)
    again = spark.read.parquet(os.path.join(scratch, "sink")).agg(F.count(F.lit(1))).first()[0]
    assert again == want.agg(F.sum("count")).first()[0]
