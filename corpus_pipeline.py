"""The training-data pipeline: five stages over ``documents``, each by one llm operator.

A stage gets what its predecessor kept.  All stages but the last return the columns of
the documents they got; ``run`` writes each result to the shared folder and reads it back.

Defined results: null and empty texts pass every stage but the removal of toxic ones (they score
like a text without a match) and end with no ids; a null id is an id like others, but never
names a group of near copies that has another; repeated rows of one text are near copies, of which
one stays; further columns, whatever their names, are carried through to the last stage; an empty
table gives an empty result.
"""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowlens.llm import decontam, ngramjoin, piecebpe, substrings, toxicity
from flowlens.llm.workspace import bound_batches, free_names, small_batches, stored


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the toxicity threshold."""
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    (name,) = free_names(["toxic_score"], docs.columns)
    return toxicity.score(docs, model, name).where(F.col(name) < toxicity.THRESHOLD).drop(name)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: that of the smallest id."""
    return ngramjoin.keep_one(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that also start earlier; ``n_chars`` follows the text."""
    cut = substrings.remove_repeats(docs)
    return cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return decontam.decontaminate(docs, _table(spark, sf_dir, "benchmark"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document and the digests of its round trip."""
    return piecebpe.round_trip_digest(docs, public_tokenizers.path("piece_bpe_32k.model"))


def _bounded(stage):
    """The stage in a session that hands its workers few texts at once: also in the job that writes the stage's result."""
    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bound_batches(spark)
        return stage(spark, docs, sf_dir)
    return run


STAGES = [(name, _bounded(stage)) for name, stage in [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("substring_dedup", cut_repeated_passages),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode_pieces),
]]

#: SQL cannot express the toxicity model and the tokenizer; tests check the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is written and read again."""
    docs = _table(spark, sf_dir, "documents")
    with small_batches(spark):
        for name, stage in STAGES:
            docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
