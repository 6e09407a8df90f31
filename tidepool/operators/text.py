"""Web-scale text: page cleaning, tokens, n-grams, hosts, sentences.

Everything is a lazy narrow transformation until a grouped count; the corpus
is never cached (it is scanned once per plan) and never collected.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.functions import text as tx


def english_stop_words() -> list[str]:
    """Spark ML's default English stop list (the reference's remover default).

    Read from the MLlib jar that ships with PySpark (no JVM needed, so the
    DuckDB oracle can use the very same list); falls back to the JVM loader.
    """
    import glob
    import os
    import zipfile

    import pyspark
    jars = glob.glob(os.path.join(os.path.dirname(pyspark.__file__), "jars", "spark-mllib_*.jar"))
    for jar in jars:
        with zipfile.ZipFile(jar) as z:
            try:
                return z.read("org/apache/spark/ml/feature/stopwords/english.txt").decode("utf-8").split()
            except KeyError:
                continue
    from pyspark.ml.feature import StopWordsRemover
    return list(StopWordsRemover.loadDefaultStopWords("english"))


def clean_pages(df: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """Strip markup from raw pages into one line of plain text."""
    return df.withColumn(out, tx.strip_tags(html))


def add_host(df: DataFrame, url: str = "url", out: str = "host") -> DataFrame:
    """Host of each page URL (sub-domain kept)."""
    return df.withColumn(out, tx.url_host(url))


def unigrams(df: DataFrame, text: str = "text", keep: Sequence[str] = ("url",),
             stop_words: Iterable[str] | None = None, pattern: str = " ",
             drop_empty: bool = True, trim: bool = False, out: str = "ngram") -> DataFrame:
    """One row per token: ``keep`` columns plus the token.

    Tokens are lower-cased and split on ``pattern``; stop words are removed
    inside the array (JVM-side) before the explode, so they never become rows.
    The reference pipeline is ``pattern="\\s", stop_words=english_stop_words(),
    drop_empty=False, trim=True``.
    """
    toks = tx.tokenize(text, pattern=pattern, drop_empty=drop_empty)
    if stop_words:
        toks = tx.remove_stop_words(toks, stop_words)
    rows = df.select(*keep, F.explode(toks).alias(out))
    if trim:
        rows = rows.withColumn(out, F.trim(out))
    return rows


def ngrams(df: DataFrame, n: int, text: str = "text", keep: Sequence[str] = ("url",),
           stop_words: Iterable[str] | None = None, pattern: str = " ",
           out: str = "ngram") -> DataFrame:
    """One row per n-gram (space-joined) of each text; short texts give none."""
    toks = tx.tokenize(text, pattern=pattern, drop_empty=True)
    if stop_words:
        toks = tx.remove_stop_words(toks, stop_words)
    # Tokens become a column first: the n-gram lambda then slices a ready
    # array instead of re-splitting the text once per position.
    staged = df.select(*keep, toks.alias("_toks"))
    return staged.select(*keep, F.explode(tx.ngram_array("_toks", n)).alias(out))


def ngram_counts(grams: DataFrame, ngram: str = "ngram", doc: str = "page_id",
                 approx_rsd: float | None = None) -> DataFrame:
    """Occurrences and pages per n-gram, in one grouped pass.

    Pages is an exact distinct count: Spark de-duplicates (ngram, doc) with a
    map-side partial aggregate first, so a hot n-gram is not one big group.
    ``approx_rsd`` switches pages to a HyperLogLog++ estimate (billions of
    n-grams, fixed-size sketches instead of (ngram, doc) pairs).
    """
    pages = (F.countDistinct(doc) if approx_rsd is None
             else F.approx_count_distinct(doc, rsd=approx_rsd))
    return grams.groupBy(ngram).agg(F.count(F.lit(1)).alias("n"), pages.alias("pages"))


def host_counts(pages: DataFrame, host: str = "host", page: str = "page_id") -> DataFrame:
    """Distinct pages per host; URLs without a host are left out."""
    return pages.where(F.col(host).isNotNull()).groupBy(host).agg(F.countDistinct(page).alias("pages"))


def sentences(df: DataFrame, text: str = "text", doc: str = "doc_id",
              pattern: str = tx.SENTENCE_SPLIT) -> DataFrame:
    """One row per non-blank sentence: (doc, sentno, sentence).

    The sentence id is kept as two columns (document, number) rather than a
    ``<url>_sentid_<n>`` string.
    """
    return (df.select(doc, F.posexplode(tx.split_sentences(text, pattern)).alias("sentno", "sentence"))
            .where(F.trim("sentence") != ""))


def dedupe_sentences(sents: DataFrame, doc: str = "doc_id", sentence: str = "sentence") -> DataFrame:
    """Distinct sentences within a document; repeats across documents are kept."""
    return sents.select(doc, sentence).distinct()


def distinct_sentences(df: DataFrame, text: str = "text", doc: str = "doc_id",
                       pattern: str = tx.SENTENCE_SPLIT) -> DataFrame:
    """(doc, sentno, sentence): the distinct non-blank sentences of each row.

    The de-duplication is a matter of one row, so no sentence is shuffled.
    """
    kept = F.filter(F.array_distinct(tx.split_sentences(text, pattern)), lambda x: F.trim(x) != "")
    return df.select(doc, F.posexplode(kept).alias("sentno", "sentence"))


def units(df: DataFrame, text: str = "text", keep: Sequence[str] = ("url",), n: int = 2, out: str = "w",
          distinct: bool = True) -> DataFrame:
    """One row per word and per phrase of up to ``n`` words, from one word array per text.

    Words are without the signs at their edges. With ``distinct`` a unit is one
    row however often the text has it.
    """
    staged = df.select(*keep, tx.plain_words(text).alias("_words"))
    found = tx.words_and_phrases("_words", n)
    return staged.select(*keep, F.explode(F.array_distinct(found) if distinct else found).alias(out))
