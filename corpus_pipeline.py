"""The corpus pipeline: documents pass the stages below in order; each works on all that its predecessor kept.

All stages but the last return the columns of ``documents``. The last returns one row of token ids per document.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.llm import bpe, minhash, secrets
from tillflow.llm import decontaminate as decon
from tillflow.llm import quality as ranking
from tillflow.llm.common import table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
RANK_FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose predicted quality is 1. Labels of the held-out fold are not learned from."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return ranking.score_quality(docs.select(*COLUMNS), labels).where("predicted = 1").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates: five words a shingle, similarity 0.8 or more."""
    return minhash.near_duplicates(docs.select(*COLUMNS)).where("kept").select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a window of ten words, or a whole shorter item, of the benchmark."""
    marked = decon.mark_contamination(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))
    return marked.where(~F.col("contaminated")).select(*COLUMNS)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret in the texts by a mark; documents stay, their length is counted anew."""
    clean = secrets.redact(secrets.find_secrets(docs.select(*COLUMNS)))
    return clean.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the digest of the bytes they decode to."""
    ranks = bpe.read_ranks(RANK_FILE)
    both = bpe.decode(bpe.encode(docs, ranks, pattern=public_tokenizers.PATTERN), ranks)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
                       F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan),
    ("byte-level BPE", byte_bpe),
]

# The learned classifier, the secret rules' positions and the merges of the encoding are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
