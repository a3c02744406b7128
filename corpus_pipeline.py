"""documents made ready for training, stage by stage.

Each stage gets what the last one kept, with the columns of documents, and what it decides takes effect:
toxic documents go, of near-duplicates one stays, passages that earlier documents have and passages of
the benchmark are cut out, and what is left is packed into sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketmill.llm import decontam, packing, passages, simhash, toxicity
from ticketmill.llm.storage import kept


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain finds toxic go; null and empty texts stay."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = toxicity.toxicity(docs, toxicity.train(docs, labels))
    return scored.filter(~F.col("is_toxic")).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the least id."""
    return simhash.one_of_each(docs, width=4, max_bits=4)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that earlier documents have are cut out; documents of nothing else go."""
    return with_length(passages.without_passages(docs)).select(docs.columns)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words inside benchmark windows are cut out; every document stays."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = decontam.contamination(docs, benchmark).withColumn("text", F.col("clean_text"))
    return with_length(rows).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces with their places in sequences of 1,024 tokens."""
    return packing.pack(
        docs,
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
    )


def with_length(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.char_length("text").cast("long"))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_passages),
    ("benchmark_decontamination", cut_benchmark),
    ("best_fit_packing", pack),
]

#: Models, token ids and fingerprints take part: no SQL. tests/llm has the brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the last stage gives. Each stage is written to the shared folder and read again, so it runs once."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = kept(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
