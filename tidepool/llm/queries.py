"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import (chat, collocations, debruijn, jaccard, langid, lines, mixing, packing, pfp, secret_scan, sharding, topk,
                          whitening)
from tidepool.llm.common import table


def op1_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and cross-document line frequency over all documents."""
    return lines.line_rules(table(spark, sf_dir, "documents"))


def op2_debruijn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the words of 35-word windows that repeat."""
    out = debruijn.drop_repeated_words(table(spark, sf_dir, "documents"), digest=True)
    return out.select("doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 highest integer inner products of every fiftieth vector."""
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts are control strings, formatted and read back."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit("</s>[INST] ok [/INST]").alias("text"))
    made = chat.format_chat(given.unionByName(probe)).withColumns({
        "turns": chat.parse_chat(F.col("formatted")), "trained": chat.loss_text(F.col("segments"))})
    each = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return made.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.concat_ws("", each), 256).alias("turns_sha256"),
        F.length("trained").cast("long").alias("loss_chars"), F.sha2("trained", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid")


def op5_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the weights of their sources."""
    return mixing.pareto_mix(table(spark, sf_dir, "documents"))


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of all documents, learned from those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    asked = docs.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "text")
    return langid.predict(asked, langid.train(langid.learnable(docs))).drop("text")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents by patterns and Markov models."""
    docs = table(spark, sf_dir, "documents")
    out = secret_scan.scan_secrets(docs.select("doc_id", "text"), secret_scan.train_models(docs))

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return out.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                      F.sha2(secret_scan.told(F.col("base")), 256).alias("base_sha256"), secret_scan.told(F.col("spans")).alias("spans"))


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents by the Jaccard similarity of their 4-word shingles."""
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), size=4, percent=85)


def op9_pfp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes of 400-byte strings that repeat."""
    return pfp.drop_repeated_bytes(table(spark, sf_dir, "documents"), digest=True).drop("kept")


def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of equal counts, each with the mixture of the sources."""
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    out = sharding.interleave(docs, shards=40, seed=0, order=("doc_id", "size", "text_crc32"))
    return out.select("doc_id", "source", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op12_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors on the 16 strongest components of the distinct ones, whitened."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    model = whitening.fit(vectors, components=16)
    white = whitening.transform(vectors, model)
    explained = F.array(*[F.lit(e) for e in model.explained]) if model and model.explained else F.array().cast("array<double>")
    return (white.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n if model else 0).cast("long").alias("n"), "deviation",
                    "whitened", F.get(explained, F.col("at")).alias("explained"),
                    F.lit(model.identity_error if model else 0.0).alias("identity_error")))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2000 strongest phrases of 2 to 5 words over all documents."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_lines, op2_debruijn, op3_topk, op4_chat, op5_mix, op6_langid, op7_secrets, op8_jaccard, op9_pfp,
                                   op10_pack, op11_interleave, op12_whiten, op13_collocations)}
