"""Dictionary matching over tokens: hits, counts, co-occurrence, funnels.

Dictionaries are term tables. They are broadcast only after a bounded size
check; otherwise the match is a shuffle join that AQE plans at run time. The
token side is never shuffled before the match when the dictionary broadcasts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.functions import text as tx
from tidepool.functions.joins import bounded_broadcast
from tidepool.functions.scalars import count_ratio
from tidepool.operators.phrases import phrase_hits
from tidepool.session import materialize


def term_hits(tokens: DataFrame, dictionary: DataFrame, token: str = "w",
              term: str = "term") -> DataFrame:
    """Token rows that equal a dictionary term, with the dictionary's columns."""
    d = bounded_broadcast(dictionary)
    return tokens.join(d, tokens[token] == d[term]).drop(tokens[token])


def term_counts(hits: DataFrame, keys: list[str] | str = "term", doc: str = "page_id") -> DataFrame:
    """Pages (distinct documents) and occurrences per term."""
    ks = [keys] if isinstance(keys, str) else keys
    return hits.groupBy(*ks).agg(F.countDistinct(doc).alias("pages"),
                                 F.count(F.lit(1)).alias("occurrences"))


def label_counts(hits: DataFrame, label: str = "label", term: str = "term",
                 doc: str = "page_id") -> DataFrame:
    """Distinct terms, pages and occurrences per dictionary label."""
    return hits.groupBy(label).agg(F.countDistinct(term).alias("terms"),
                                   F.countDistinct(doc).alias("pages"),
                                   F.count(F.lit(1)).alias("occurrences"))


def merge_variants(hits: DataFrame, term: str = "term", strip: str = ".,") -> DataFrame:
    """Fold spelling variants onto one term (trailing punctuation removed)."""
    return hits.withColumn(term, tx.strip_trailing(term, strip))


def variant_map(dictionary: DataFrame, term: str = "term", strip: str = ".,") -> DataFrame:
    """Variant -> canonical pairs inside one dictionary: a term whose stripped
    form (trailing punctuation removed) is itself a term maps onto it."""
    d = dictionary.select(F.col(term).alias("variant")).distinct()
    c = dictionary.select(F.col(term).alias("canonical")).distinct()
    v = d.withColumn("_stripped", tx.strip_trailing("variant", strip))
    return (v.join(c, (v["_stripped"] == c["canonical"]) & (v["variant"] != c["canonical"]))
            .select("variant", "canonical"))


def canonicalize(hits: DataFrame, variants: DataFrame, term: str = "term",
                 variant: str = "variant", canonical: str = "canonical") -> DataFrame:
    """Replace variant terms by their canonical form through a variant map
    (left join, broadcast after its size check); other terms are kept."""
    m = bounded_broadcast(variants.select(F.col(variant).alias("_v"), F.col(canonical).alias("_c")))
    j = hits.join(m, hits[term] == m["_v"], "left")
    return j.withColumn(term, F.coalesce(F.col("_c"), F.col(term))).drop("_v", "_c")


# Plural endings and what stands for them in the singular, tried in this order; endings that are no plural.
PLURALS = (("ies", "y"), ("ches", "ch"), ("shes", "sh"), ("sses", "ss"), ("xes", "x"), ("zes", "z"), ("s", ""))
NO_PLURAL = ("ss", "us", "is")


def singular_map(words: DataFrame, word: str = "w", least: int = 3) -> DataFrame:
    """(variant, canonical): plurals whose singular is a word of the same corpus.

    Each distinct word proposes, for every ending it has, the singular of at
    least ``least`` letters; a proposal counts only if the corpus holds it, and
    the first of ``PLURALS`` wins. Both sides of that join are the vocabulary,
    made distinct map-side, never the corpus.
    """
    v = materialize(words.select(F.col(word).alias("variant")).where(F.col("variant").isNotNull()).distinct())
    stem = lambda e: F.substring(F.col("variant"), F.lit(1), F.length("variant") - len(e))
    tries = F.array(*[F.when(F.col("variant").endswith(e), F.struct(F.lit(k).alias("_k"), F.concat(stem(e), F.lit(to)).alias("canonical")))
                      for k, (e, to) in enumerate(PLURALS)])
    none = F.col("variant").endswith(NO_PLURAL[0])
    for e in NO_PLURAL[1:]:
        none = none | F.col("variant").endswith(e)
    told = (v.where(~none).select("variant", F.explode(tries).alias("_t")).where(F.col("_t").isNotNull()).select("variant", "_t.*")
            .where(F.length("canonical") >= least))
    held = told.join(v.select(F.col("variant").alias("_v")), F.col("canonical") == F.col("_v"), "left_semi")
    return held.groupBy("variant").agg(F.min(F.struct("_k", "canonical")).alias("_m")).select("variant", "_m.canonical")


def is_phrase(term: str = "term"):
    """True for multi-word terms (at least one blank)."""
    return F.regexp_count(F.col(term), F.lit(" ")) > 0


def _tagged(dict_a: DataFrame, dict_b: DataFrame, term: str) -> DataFrame:
    a = dict_a.select(F.col(term).alias("_term"), F.lit(True).alias("_a"), F.lit(False).alias("_b"))
    b = dict_b.select(F.col(term).alias("_term"), F.lit(False).alias("_a"), F.lit(True).alias("_b"))
    return a.unionByName(b).groupBy("_term").agg(F.bool_or("_a").alias("_a"), F.bool_or("_b").alias("_b"))


def document_flags(tokens: DataFrame, dict_a: DataFrame, dict_b: DataFrame, doc: str = "doc_id",
                   token: str = "w", term: str = "term") -> DataFrame:
    """Per document: has a term of A, has a term of B (one broadcast match).

    Both dictionaries are merged into one tagged table so the tokens are
    matched once; the per-document flags are partially aggregated map-side.
    """
    d = bounded_broadcast(_tagged(dict_a, dict_b, term))
    j = tokens.join(d, tokens[token] == d["_term"], "left")
    return j.groupBy(doc).agg(F.coalesce(F.bool_or("_a"), F.lit(False)).alias("has_a"),
                              F.coalesce(F.bool_or("_b"), F.lit(False)).alias("has_b"))


def cooccurring_docs(tokens: DataFrame, dict_a: DataFrame, dict_b: DataFrame, doc: str = "doc_id",
                     token: str = "w", term: str = "term") -> DataFrame:
    """Documents with at least one hit in each of two dictionaries."""
    d = bounded_broadcast(_tagged(dict_a, dict_b, term))
    j = tokens.join(d, tokens[token] == d["_term"])
    flags = j.groupBy(doc).agg(F.bool_or("_a").alias("has_a"), F.bool_or("_b").alias("has_b"))
    return flags.where("has_a AND has_b").select(doc)


def funnel(tokens: DataFrame, dict_a: DataFrame, dict_b: DataFrame, doc: str = "doc_id",
           token: str = "w", term: str = "term") -> DataFrame:
    """Narrowing funnel in one pass: all documents -> with A -> with A and B.

    Counts come from a single aggregate of per-document flags, then are laid
    out one row per stage.
    """
    flags = document_flags(tokens, dict_a, dict_b, doc, token, term)
    one = flags.agg(F.count(F.lit(1)).alias("s1"), F.count_if("has_a").alias("s2"),
                    F.count_if(F.col("has_a") & F.col("has_b")).alias("s3"))
    stages = F.array(
        F.struct(F.lit(1).alias("stage_no"), F.lit("documents").alias("stage"), F.col("s1").alias("documents")),
        F.struct(F.lit(2).alias("stage_no"), F.lit("with_dict_a").alias("stage"), F.col("s2").alias("documents")),
        F.struct(F.lit(3).alias("stage_no"), F.lit("with_dict_a_and_b").alias("stage"),
                 F.col("s3").alias("documents")),
    )
    return one.select(F.inline(stages))


def term_density(tokens: DataFrame, dictionary: DataFrame, doc: str = "doc_id",
                 token: str = "w", term: str = "term") -> DataFrame:
    """Per document: tokens, dictionary hits and hits per token."""
    d = bounded_broadcast(dictionary.select(F.col(term).alias("_term")).distinct())
    j = tokens.join(d, tokens[token] == d["_term"], "left")
    agg = j.groupBy(doc).agg(F.count(F.lit(1)).alias("tokens"), F.count("_term").alias("hits"))
    return agg.withColumn("density", count_ratio("hits", "tokens"))


def cooccurring_pages(tokens: DataFrame, dict_a: DataFrame, dict_b: DataFrame, page: str = "page_id",
                      token: str = "w", term: str = "term") -> DataFrame:
    """Pages with a hit in each of two dictionaries (``cooccurring_docs`` keyed by page)."""
    return cooccurring_docs(tokens, dict_a, dict_b, page, token, term)


def sentence_hits(sentences: DataFrame, dictionary: DataFrame, doc: str = "doc_id", sentno: str = "sentno",
                  sentence: str = "sentence", term: str = "term") -> DataFrame:
    """Dictionary words and phrases of any length inside sentences: (doc, sentno, term, ...), a row for each place.

    Matching is ``phrases.phrase_hits``: an index by first word, no n-grams;
    words are without the signs at their edges. The sentence's text is never
    shuffled, its number is. The dictionary's other columns come along.
    """
    found = phrase_hits(sentences, dictionary, sentence, [doc, sentno], term).drop("at", "size")
    if dictionary.columns == [term]:
        return found
    d = bounded_broadcast(dictionary.withColumnRenamed(term, "_term"))
    return found.join(d, found[term] == d["_term"]).drop("_term")


def sentence_label_counts(hits: DataFrame, label: str = "label", doc: str = "doc_id",
                          sentno: str = "sentno") -> DataFrame:
    """Sentences and documents with at least one hit, per dictionary label."""
    per = hits.select(label, doc, sentno).distinct().groupBy(label, doc).agg(F.count(F.lit(1)).alias("_n"))
    return per.groupBy(label).agg(F.sum("_n").cast("bigint").alias("sentences"), F.count(F.lit(1)).alias("documents"))


def cooccurring_sentences(sentences: DataFrame, dict_a: DataFrame, dict_b: DataFrame, doc: str = "doc_id",
                          sentno: str = "sentno", sentence: str = "sentence", term: str = "term") -> DataFrame:
    """(doc, sentno) of the sentences that hold a word or phrase of each of two dictionaries."""
    hits = sentence_hits(sentences, _tagged(dict_a, dict_b, term).withColumnRenamed("_term", term), doc, sentno, sentence, term)
    flags = hits.groupBy(doc, sentno).agg(F.bool_or("_a").alias("_a"), F.bool_or("_b").alias("_b"))
    return flags.where("_a AND _b").select(doc, sentno)


def funnel_stages(found: DataFrame, stages: Sequence[tuple[str, str, DataFrame]], doc: str = "doc_id", token: str = "w",
                  term: str = "term", first: str = "documents") -> DataFrame:
    """Narrowing funnel with any number of stages: (stage_no, stage, documents).

    A stage is (name, kind, dictionary): ``any`` keeps the documents with one
    of its terms, ``none`` those without (an exclusion list). Dictionaries of a
    category are theirs to filter. All of them are one table of terms with a
    flag per stage, matched once against the units ``found``; a document is
    one row of flags, counted in one aggregate.
    """
    tagged = None
    for k, (_, kind, dictionary) in enumerate(stages):
        if kind not in ("any", "none"):
            raise ValueError(f"unknown kind of stage {kind!r}")
        one = dictionary.select(F.col(term).alias("_term"), F.lit(1 << k).cast("bigint").alias("_bit")).distinct()
        tagged = one if tagged is None else tagged.unionByName(one)
    d = bounded_broadcast(tagged.groupBy("_term").agg(F.bit_or("_bit").alias("_bits")))
    flags = found.join(d, found[token] == d["_term"], "left").groupBy(doc).agg(F.coalesce(F.bit_or("_bits"), F.lit(0)).alias("_bits"))
    passed, counts = F.lit(True), [F.count(F.lit(1)).alias("_s0")]
    for k, (_, kind, _) in enumerate(stages):
        passed = passed & (F.col("_bits").bitwiseAND(1 << k) != 0 if kind == "any" else F.col("_bits").bitwiseAND(1 << k) == 0)
        counts.append(F.count_if(passed).alias(f"_s{k + 1}"))
    rows = [F.struct(F.lit(k + 1).alias("stage_no"), F.lit(name).alias("stage"), F.col(f"_s{k}").alias("documents"))
            for k, name in enumerate([first, *(s[0] for s in stages)])]
    return flags.agg(*counts).select(F.inline(F.array(*rows)))
