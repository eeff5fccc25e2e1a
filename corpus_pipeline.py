"""The corpus pipeline: five operators of the llm subpackage, each on all that its predecessor kept."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skillweave.llm import bpe_replay, decontaminate, jaccard_forest, line_dedup, line_frequency
from skillweave.llm.common import drop_folder, shared_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without their frequent lines."""
    return line_frequency.apply_quality(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that an earlier line repeats within one edit; a document may be left empty."""
    return line_dedup.dedup_lines(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that with the smallest id."""
    return jaccard_forest.keep_first(docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids (little-endian unsigned 32-bit integers) of each document; ids that did not
    decode to the text would stop the job."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    out = bpe_replay.encode(docs.select("doc_id", "lang", "source", F.xxhash64(F.coalesce("text", F.lit("")).cast("binary")).alias("th"), "text"), path, public_tokenizers.PATTERN)
    out = bpe_replay.decode(out.drop("text"), path)
    same = F.xxhash64("decoded") == F.col("th")
    return out.select("doc_id", "lang", "source", F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"), F.when(same, F.col("ids")).otherwise(F.raise_error(F.lit("ids do not decode to the text")).cast("binary")).alias("ids"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", dedup_lines),
    ("jaccard_join", jaccard_join),
    ("decontaminate", decontaminate_benchmark),
    ("bpe_encode", encode),
]

#: The stages have no SQL form; tests/llm/test_pipeline.py holds the run against the operators' brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; each result is written to the shared folder and read again, and goes once the next is
    written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    before = None
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            drop_folder(spark, before)
        before = path
    return docs
