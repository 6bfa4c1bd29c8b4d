"""Documents made ready for training: five stages, each written as Parquet and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from energylake.llm import decontamination, pii, sentencepiece_bpe, simhash, toxicity
from energylake.session import scratch_path

TOKENIZER = public_tokenizers.path("piece_bpe_32k.model")
# Shingle length and bit distance of the near-duplicate contract.
SHINGLE_WORDS, BIT_DISTANCE = 4, 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxic_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold; learned on these documents."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def copies_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the least doc_id."""
    return simhash.keep_one(docs, SHINGLE_WORDS, BIT_DISTANCE)


def leaks_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no window of the benchmark occurs."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def persons_out(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in their texts replaced and n_chars counted anew."""
    clean = pii.redact(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.length("text").cast(kind))
    return clean


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens and the text decoded from the ids."""
    ids = sentencepiece_bpe.encode(docs, TOKENIZER)
    return sentencepiece_bpe.decode(ids, TOKENIZER).select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), "decoded")


STAGES = [("toxicity", toxic_out), ("simhash", copies_out), ("decontamination", leaks_out),
          ("pii", persons_out), ("sentencepiece", encoded)]

# A trained classifier and fingerprints by XXH64 are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
