"""End-to-end web-text job (the reference's corpus mining flow).

corpus {url, text} -> tokens (stop words removed) and bigrams -> dictionary
matches -> hit table (written, read back) -> pages and occurrences per term
and per label -> top-k CSV report.

The corpus is scanned and split into words once; dictionary matches are broadcast joins
after a size check, so tokens are never shuffled before the match; the hit
table (much smaller than the tokens) is written once and every summary reads
it instead of re-tokenising the corpus.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.functions import text as tx
from tidepool.operators import terms, text
from tidepool.sources import io


def build_web_terms(corpus: DataFrame, dictionary: DataFrame, out_dir: str,
                    stop_words: Iterable[str] | None = None, ngram_sizes: tuple[int, ...] = (1, 2),
                    url: str = "url", top: int = 100) -> dict[str, str]:
    """Mine ``corpus`` (url, text) for the terms of ``dictionary`` (term[, label])."""
    spark = corpus.sparkSession
    out = out_dir.rstrip("/")
    paths = {k: f"{out}/{k}" for k in ("hits", "term_counts", "label_counts", "top_terms")}
    stop = list(stop_words) if stop_words is not None else text.english_stop_words()
    if "label" not in dictionary.columns:
        dictionary = dictionary.withColumn("label", F.lit(None).cast("string"))
    # One word array per page; words but stop words, and phrases of the whole array.
    staged = corpus.select(url, tx.plain_words("text").alias("_words"))
    found = F.array().cast("array<string>")
    for n in ngram_sizes:
        part = tx.ngram_array("_words", n) if n > 1 else tx.remove_stop_words("_words", stop)
        found = F.concat(found, part)
    tokens = staged.select(url, F.explode(found).alias("w"))
    hits = terms.term_hits(tokens, dictionary.select("term", "label").distinct())
    io.write_table(hits.select(url, "term", "label"), paths["hits"])
    hits = spark.read.parquet(paths["hits"])

    io.write_table(terms.term_counts(hits, ["term", "label"], doc=url), paths["term_counts"])
    io.write_table(terms.label_counts(hits, doc=url), paths["label_counts"])
    counts = spark.read.parquet(paths["term_counts"])
    report = counts.orderBy(F.desc("occurrences"), F.asc("term")).limit(top)
    io.write_table(report, paths["top_terms"], fmt="csv")
    return paths


def main() -> None:
    ap = argparse.ArgumentParser(description="Dictionary term counts over a JSON-lines corpus.")
    ap.add_argument("--corpus", required=True, help="JSON lines {url, text}, glob allowed")
    ap.add_argument("--dictionary", required=True, help="CSV with header: term[,label]")
    ap.add_argument("--out", required=True, help="output folder on shared storage")
    args = ap.parse_args()
    from tidepool.session import get_session
    spark = get_session("tidepool-web-terms")
    dictionary = io.read_table(spark, args.dictionary, "csv", "term string, label string")
    paths = build_web_terms(io.read_corpus(spark, args.corpus), dictionary, args.out)
    print(json.dumps(paths))
    spark.stop()


if __name__ == "__main__":
    main()

