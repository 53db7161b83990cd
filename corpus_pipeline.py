"""The corpus pipeline: language ID, SimHash near-dedup, suffix-array dedup,
mixing to target weights, SentencePiece encoding. Each stage reads what its
predecessor kept, written as Parquet in between; all but the last return the
columns of documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lograft.llm import language_id, mixing, piece_viterbi, simhash_dedup, suffix_dedup
from lograft.llm.common import drop, land, table


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of no identifiable language go."""
    return language_id.keep_identified(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (3-word shingles, 3 bits)."""
    return simhash_dedup.keep_first(docs, shingle=3, max_bits=3)


def suffix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 100 bytes that start earlier in the corpus are cut out."""
    return suffix_dedup.dedup_text(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.apply_mix(docs)


def piece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts, digests of the ids and the round-trip check of each row."""
    return piece_viterbi.piece_digest(docs, public_tokenizers.path(piece_viterbi.MODEL))


STAGES = [
    ("language_id", language_stage),
    ("simhash_near_dedup", simhash_stage),
    ("suffix_array_dedup", suffix_stage),
    ("source_mix", mix_stage),
    ("sentencepiece", piece_stage),
]

# Fingerprints, fitted models and token ids are not SQL; the stages are tested
# against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = land(stage(spark, docs, sf_dir), name)
        if before is not None:          # its successor is written
            drop(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
