"""A corpus pipeline: each stage reads what its predecessor kept and returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from driftline.llm import exact_dedup, minhash, mixing, packing, toxicity
from driftline.llm.common import materialise


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text the model of the labels finds toxic go; empty and null texts stay, repeated rows share a verdict."""
    return toxicity.apply_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for case, the row with the largest id stays; null texts count as empty, repeated rows leave one."""
    return exact_dedup.apply_exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays, and every row without words."""
    return minhash.apply_near_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time that the mix takes a document, cut at its source's budget; texts without words are never taken."""
    return mixing.apply_mix(docs)


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens in windows of 1,024, a row each; null texts have their end alone."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mix_sources", mix_sources),
    ("pack", pack_windows),
]

#: Toxicity, MinHash and tokens are beyond SQL; the tests hold the stages but the first against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
