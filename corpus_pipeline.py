"""Corpus pipeline: language ID, exact dedup, near-duplicate join, mixing, SentencePiece encoding.

Each stage is a function of (spark, docs, sf_dir) and works on all rows that the
one before it kept. All but the last give back the columns of ``documents``.
``run`` writes the result of each stage as Parquet to the shared folder and
reads it again as the next one's documents, so a lost executor costs at most the
stage at hand.

Rows with a null or repeated doc_id: stages that keep some rows of a group keep
exactly one. An empty table passes through every stage.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import exact_dedup, jaccard_join, language_id, mixing, pieces
from ledgerlens.llm.common import materialize, read
from ledgerlens.llm.queries import TARGETS

#: No stage's rows follow from SQL alone: the first learns a model, the last segments texts.
ORACLE_SQL = None


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language is found: those without a letter go."""
    return language_id.keep_identified(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts (A-Z lower-cased) the one with the largest doc_id."""
    return exact_dedup.drop_exact_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by similar shingle sets the one with the smallest doc_id."""
    return jaccard_join.drop_near_duplicates(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights ask: a row is left out, kept or repeated."""
    labelled = mixing.quality_domains(read(spark, sf_dir, "labels"))
    return mixing.mixed_documents(docs, labelled, TARGETS)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, piece ids of the best segmentation, and the scores and changes of the N best."""
    return pieces.encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [("language ID", languages), ("exact dedup", exact_duplicates), ("n-gram Jaccard join", near_duplicates),
          ("mixing to target weights", mixture), ("SentencePiece encoding", encoding)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages, applied in turn to the documents of ``sf_dir``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
