"""A corpus pipeline: language, near duplicates, secrets, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; what it returns is written as Parquet and read again by the next one.
All but the last return the columns of their input.

Defined results, for each stage: an empty table gives an empty one; further
columns pass through, whatever their names; a NULL ``lang`` is filled in by the
first stage, where no language can be learned no document is in one. NULL and
empty texts have no language and go in the first stage; a stage that is given
them keeps them (near duplicates: all of them), without a secret, with size 0 in
the mix, so they are not taken. Repeated rows are near duplicates of each other,
rows of their own to every other stage. Ties go to the smallest id.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import jaccard, langid, mixing, packing, secret_scan
from tidepool.llm.common import fresh, table, written


def language(spark: SparkSession, docs: DataFrame, sf_dir: str, margin: float = 2 / 15) -> DataFrame:
    """Documents in a learned language; those without letters or with too low a score go. A missing ``lang`` is filled in.

    With k languages learned, no best score is below 1 / k; a score has to
    be above that by ``margin`` of the way to 1 (0.35 with four languages).
    """
    pred, score = fresh(docs, "lang_pred"), fresh(docs, "lang_score")
    model = langid.train(langid.learnable(docs))
    chance = 1 / max(1, len(model.langs))
    told = langid.predict(docs, model, lang_out=pred, score_out=score)
    kept = told.filter((F.col(pred) != "und") & (F.col(score) >= chance + margin * (1 - chance) - 1e-9))
    return kept.withColumn("lang", F.coalesce("lang", pred)).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles with a similarity of 0.8 link: the one with the smallest id."""
    return jaccard.one_of_each(docs, size=5, percent=80).select(docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret and ``n_chars`` counted again."""
    model = secret_scan.train_models(docs)
    key = fresh(docs, "whole")
    found = secret_scan.scan_secrets(docs.select(F.struct(*docs.columns).alias(key), "text"), model)
    clean = F.when(F.size("spans") > 0, secret_scan.redact(F.col("text"), F.col("spans"))).otherwise(F.col("text"))
    out = found.select(F.col(f"{key}.*"), clean.alias(fresh(docs, "clean")))
    text = out.columns[-1]
    return out.withColumns({"text": F.col(text), "n_chars": F.when(F.col(text).isNull(), F.col("n_chars")).otherwise(
        F.length(text).cast(docs.schema["n_chars"].dataType))}).select(docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it. Rows that are equal in all columns share their copies."""
    key, hashed, often = fresh(docs, "key"), fresh(docs, "hashed"), fresh(docs, "often")
    rows = docs.withColumn(hashed, F.xxhash64(*docs.columns))
    asked = rows.select(F.struct("doc_id", hashed).alias(key), "text", "source")
    taken = mixing.pareto_mix(asked, id_col=key).filter("copies > 0").groupBy(key).agg(F.sum("copies").cast("int").alias(often))
    taken = taken.select(F.col(f"{key}.doc_id").alias("of"), F.col(f"{key}.{hashed}").alias("oh"), often)
    one = rows.dropDuplicates(["doc_id", hashed])
    met = one.join(taken, one["doc_id"].eqNullSafe(taken["of"]) & (one[hashed] == taken["oh"]))
    return met.withColumn(often, F.explode(F.sequence(F.lit(1), F.col(often)))).select([one[c] for c in docs.columns])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("secrets", secrets), ("mix", mix), ("pack", pack)]

#: The trained and random stages have no SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each one's result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
