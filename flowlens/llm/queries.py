"""Registered queries of the llm operators, each over its whole table."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.llm import (
    decontam,
    htmltext,
    licenses,
    linequality,
    negatives,
    ngramjoin,
    piecebpe,
    queries_sql,
    runs,
    sharding,
    substrings,
    tokencount,
    tokenfiles,
    toxicity,
)
from flowlens.llm.workspace import by_value, new_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = tokencount.token_counts(_table(spark, sf_dir, "documents"),
                                     public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    return counts.withColumn("over_limit", F.col("n_tokens") > 512)


def op2_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(_table(spark, sf_dir, "documents"), 40, new_path(spark, "slot-map"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.similar_components(_table(spark, sf_dir, "documents"))


def op4_template_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(_table(spark, sf_dir, "pages"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.removal_digest(_table(spark, sf_dir, "documents"))


def op6_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linequality.judge(_table(spark, sf_dir, "documents"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = tokenfiles.write_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
                                       tokenfiles.token_file_folder(spark))
    return tokenfiles.read_documents(manifest)


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piecebpe.round_trip_digest(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.hit_digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def planted_periods(doc_id: int | None, words: np.ndarray) -> np.ndarray:
    """The contract's periodic tail of every tenth document (by the checksum of its id; a null id has none)."""
    n = len(words)
    if doc_id is None or n == 0:
        return words
    g, rest = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if rest:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([words[:a], words[a + np.arange(n - a) % p]])


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_digest(_table(spark, sf_dir, "documents"), planted_periods)


def op12_license_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_digest(_table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    return negatives.mine(_table(spark, sf_dir, "embeddings"), vec_id % 100 == 0,
                          F.when(vec_id % 7 == 0, F.pmod(label + 1, F.lit(10))).otherwise(label))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_token_counts, op2_virtual_slots, op3_ngram_jaccard, op4_template_removal, op5_substring_dedup, op6_line_frequency, op7_token_files, op8_sentencepiece,
                                      op9_decontamination, op10_toxicity, op11_periodic_runs, op12_license_notices,
                                      op13_hard_negatives)}


def oracle_sql() -> dict[str, str]:
    return queries_sql.ORACLES


by_value(__name__)
