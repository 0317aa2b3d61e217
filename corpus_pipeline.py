"""A training-corpus pipeline: each stage calls one operator and works on all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.llm._spark import stored, table, without
from kinweave.llm.bpe import bpe_encode
from kinweave.llm.decontaminate import contamination
from kinweave.llm.near_dedup import near_duplicates
from kinweave.llm.suffix_dedup import remove_repeats
from kinweave.llm.toxicity import fit_toxicity, reject_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with a toxicity of 0.5 or more; learns from the labels that op9 learns from."""
    train = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0
    return reject_toxic(docs, fit_toxicity(docs, table(spark, sf_dir, "labels"), train=train))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates (five-word shingles, similarity 0.8)."""
    return without(docs, near_duplicates(docs).where(~F.col("kept")).select("doc_id"))


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts what starts in several places out of the texts: strings of 400 bytes, and passages of over 50 words.

    A character that a cut splits goes too.

    Every document stays, if with an empty text; n_chars is that of the new text.
    """
    rest = tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars"))
    made = remove_repeats(docs, carry=rest, passages=True, characters=True)
    out = made.select("doc_id", F.col("kept").cast("string").alias("text"), *(F.col("rest")[c].alias(c) for c in rest))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of whose words a twentieth or more lie in 13-word windows of benchmark items."""
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    return without(docs, found.where("contaminated").select("doc_id"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the texts, and hashes of the ids and of what they decode to."""
    return bpe_encode(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), ("ids", "ids_sha256", "decoded_sha256"))


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("decontaminate", decontaminate),
    ("byte_bpe", byte_bpe),
]

#: SQL cannot express the learned and byte-wise stages; tests hold their operators against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written as Parquet in the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
