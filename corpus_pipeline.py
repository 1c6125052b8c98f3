"""From raw documents to token ids: five stages, each written as Parquet and read again by the next.

Scores and rules remove documents, near-duplicate groups keep one, documents that hold benchmark questions go,
and the rest is encoded.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prospectra.llm import bpe, decontaminate, outliers, quality, simhash
from prospectra.llm.queries import BPE_RANKS, DECONTAMINATION, QUALITY_THRESHOLD
from prospectra.sources.scratch import materialize, new_scratch_path, release, scratch_run


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier takes for good, as it marks them in its own query."""
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, model).where(F.col("score") >= QUALITY_THRESHOLD).select("row.*")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source."""
    return outliers.judge(docs).where("kept").select("row.*")


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate group."""
    return simhash.drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark question."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.drop_contaminated(docs, benchmark, **DECONTAMINATION)


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """`doc_id`, `n_tokens`, `ids` and the text decoded from them."""
    ranks = bpe.read_ranks(BPE_RANKS)
    finish = bpe.decoder(spark, ranks), bpe.DECODED
    decoded = bpe.encode(docs, ranks, public_tokenizers.PATTERN, finish=finish)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        "ids",
        F.col("bytes").cast("string").alias("text"),
    )


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("byte_level_bpe", byte_level_bpe),
]

#: SQL cannot express the stages; tests compare each with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each stage's rows replace those of the one before; what a stage wrote on its way goes with it."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = new_scratch_path(spark, name)
        with scratch_run(spark):
            docs = materialize(stage(spark, docs, sf_dir), name, path)
        if before is not None:
            release(spark, before)
        before = path
    return docs
