"""One query per operator over the given tables; each is ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm import bpe, merkle, minhash, mixing, pii, secrets, sharding, substrings, syncmers, whitening
from tillflow.llm import decontaminate as decon
from tillflow.llm import quality as ranking
from tillflow.llm import toxicity as lexical
from tillflow.llm.common import table
from tillflow.llm.learning import held_out
from tillflow.llm.spans import counted, joined, only


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = F.col("pii")
    return pii.find_pii(docs).select(
        "doc_id", *[counted(found, k).alias(f"n_{k}") for k in pii.BASE],
        F.sha2(joined(only(found, *pii.BASE)), 256).alias("base_sha256"), joined(found).alias("spans"),
        counted(found, "iban").alias("n_iban"))


def op2_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return syncmers.fingerprints_with_next(docs).select(
        F.col("key").alias("doc_id"), "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        syncmers.shown(F.col("own")).alias("fingerprint"), syncmers.shown(F.col("edited_own")).alias("edited_fingerprint"),
        syncmers.likeness(F.col("own"), F.col("edited_own")).alias("near_edited"),
        syncmers.likeness(F.col("own"), F.col("next")).alias("near_next"))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash.near_duplicates(docs, shingle=2).select("doc_id", "n_shingles", "component_id", "kept")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = F.col("secrets")
    return secrets.find_secrets(docs).select(
        "doc_id", *[counted(found, k).alias(f"n_{k}") for k in secrets.BASE],
        F.sha2(joined(only(found, *secrets.BASE)), 256).alias("base_sha256"), joined(found).alias("spans"))


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.shared_passages(docs).select(
        "doc_id", "start", "end", F.col("other_id").alias("other_doc_id"), "other_start", "other_end",
        F.round("similarity", 4).alias("similarity"), "copies")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = lexical.score_toxicity(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decon.mark_contamination(docs, table(spark, sf_dir, "benchmark"))
    return marked.select("doc_id", "n_words", "n_hit", "n_items",
                         F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = ranking.score_quality(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op9_bpe(spark: SparkSession, sf_dir: str, rank_file: str | None = None) -> DataFrame:
    ranks = bpe.read_ranks(rank_file or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = bpe.decode(bpe.encode(docs, ranks, pattern=public_tokenizers.PATTERN), ranks)
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.assign_shards(docs, shards=24).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    out = whitening.whiten(vectors)
    each = out.select("*", F.posexplode(F.arrays_zip("white", "shares")).alias("place", "c"))
    return each.select(
        F.col("id").alias("vec_id"), (F.col("place") + 1).alias("component"), "n", "deviation",
        F.col("c.white").alias("whitened"), F.col("c.shares").alias("explained"), "identity_error")


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return mixing.score_texts(docs).withColumnRenamed("id", "doc_id")


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*merkle.FIELDS)
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    tampered = F.when(F.coalesce(chosen, F.lit(False)), F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    presented = merkle.leaf_hash(*[tampered if c == "n_chars" else F.col(c) for c in merkle.FIELDS])
    return merkle.proofs(docs, presented=presented).drop("path")


QUERIES = {
    "op1_pii": op1_pii,
    "op2_syncmers": op2_syncmers,
    "op3_minhash": op3_minhash,
    "op4_secrets": op4_secrets,
    "op5_substrings": op5_substrings,
    "op6_toxicity": op6_toxicity,
    "op7_decontamination": op7_decontamination,
    "op8_quality": op8_quality,
    "op9_bpe": op9_bpe,
    "op10_sharding": op10_sharding,
    "op11_whitening": op11_whitening,
    "op12_mixing": op12_mixing,
    "op13_merkle": op13_merkle,
}
