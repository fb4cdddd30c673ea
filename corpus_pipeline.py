"""The corpus pipeline: five stages from documents to packed training sequences.

Each stage takes what the one before kept, written and read back as Parquet in the shared folder. The columns of documents go through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from talkmill.llm import common, linededup, minhash, mixing, packing, quality, queries


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the divergence from their language reject go."""
    return quality.judge(docs).where("kept").select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of repeated windows of three lines go from the texts; n_chars follows."""
    rest = linededup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        rest = rest.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rest.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return minhash.keep_one(docs).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are drawn so that words come near the target weights of source, language and topic."""
    return mixing.mix(docs).where("sampled").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 ids."""
    return packing.with_crc32(packing.pack(docs, tokenizer_path=queries.tokenizer_path()))


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("mixing", mix_sources), ("packing", pack)]
#: Signatures and tokenizing have no SQL; tests/llm hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
