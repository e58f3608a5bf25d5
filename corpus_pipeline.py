"""The corpus pipeline: quality, near duplicates, repeated passages, benchmark contamination, packing."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperfield.llm import packing, quality
from paperfield.llm.common import named, numbered
from paperfield.llm.decontam import contamination, is_contaminated
from paperfield.llm.minhash import near_duplicates
from paperfield.llm.suffixdedup import remove_repeats
from paperfield.session import new_location

LEAST_QUALITY = 0.3


def _keep(docs: DataFrame, chosen: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows of ``docs`` whose ids ``chosen`` returns; ids that are null or repeat are made unique for it."""
    rows, names = numbered(docs, *[c for c in docs.columns if c != "doc_id"])
    kept = chosen(rows.withColumnRenamed("_id", "doc_id")).select(F.col("doc_id").alias("_id"))
    return named(rows.join(kept, "_id", "left_semi"), names).select(docs.columns)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network, fitted on the labels, gives at least ``LEAST_QUALITY``."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, model, "_quality").filter(F.col("_quality") >= LEAST_QUALITY).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, a similarity of 0.8."""
    return _keep(docs, lambda rows: near_duplicates(rows).filter("kept"))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the characters inside strings of 100 bytes that occur earlier; n_chars is counted anew."""
    rows, names = numbered(docs, *[c for c in docs.columns if c != "doc_id"])
    found = remove_repeats(rows.select(F.col("_id").alias("doc_id"), "text"), whole_characters=True)
    texts = found.select(F.col("doc_id").alias("_id"), F.col("kept").cast("string").alias("text"))
    texts = texts.withColumn("n_chars", F.length("text").cast("long"))
    return named(rows.drop("text", "n_chars").join(texts, "_id"), names).select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words lie in windows of benchmark items."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _keep(docs, lambda rows: contamination(rows, items).filter(~is_contaminated()))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens, with their ids."""
    return packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality_filter),
    ("near_dedup", near_dedup),
    ("repeated_passages", repeated_passages),
    ("decontaminate", decontaminate),
    ("pack", pack),
]

ORACLE_SQL = None  # a network, minima and a vocabulary are no SQL; tests/llm compares with plain Python


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read again by the next one."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_location(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
