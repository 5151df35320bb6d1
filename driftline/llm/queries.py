"""The queries of this package: thin, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, exact_dedup, hnsw, html_extract, langid, merkle, minhash, mixing, packing, phrases, ppm, substring, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ppm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.ppm_score(_table(spark, sf_dir, "documents"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op6_language_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language(_table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_table(spark, sf_dir, "pages"))


def op9_hnsw_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.nearest(_table(spark, sf_dir, "embeddings"))


def op10_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op4_pack_nnls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = phrases.phrases(_table(spark, sf_dir, "documents"))
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.decode(bpe.encode(_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"), "ids"))
    return coded.select("doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(_table(spark, sf_dir, "documents"), {"text": merkle.tamper_newlines(F.col("doc_id"), F.col("text"))})


QUERIES = {f.__name__: f for f in (op1_ppm_score, op2_mix_sources, op3_exact_dedup, op4_pack_nnls, op5_minhash_near_dedup, op6_language_gru, op7_toxicity, op8_main_text, op9_hnsw_search, op10_remove_repeats, op11_phrases, op12_bpe, op13_merkle)}
ORACLES = {"op3_exact_dedup": exact_dedup.ORACLE, "op11_phrases": phrases.ORACLE, "op13_merkle": merkle.ORACLE}
