"""Training-corpus pipeline over ``documents``.

Quality rules and quality classifier drop documents, near-dedup keeps one
of each group, mixing repeats or drops documents of a source to reach its
quota, and the last stage encodes to piece ids.  Every stage works on
whole texts of all rows that the one before has kept; each result is
written as Parquet and read again before the next.

All stages return the columns of their input, the last one adds
``piece_ids``.  Rows with NULL text fail the rules; rows with NULL ids or
sources and extra columns are carried along; empty tables pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.llm import mixing, near_dedup, piece_codec, quality_classifier, quality_rules
from gaugeworks.llm.common import read_table, written
from gaugeworks.llm.queries import tokenizer_path


def quality_rules_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the compression bands."""
    return quality_rules.keep_by_rules(docs)


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at or above the threshold.  The model learns
    from the labelled rows of the whole table, as the rules have taken
    most bad examples away."""
    model = quality_classifier.fit(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return quality_classifier.keep_good(docs, model)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: the one with the smallest id (then the
    smallest text hash); of equal rows one.  Documents without words are
    no group and all stay, as do rows whose group has NULL ids only."""
    return near_dedup.keep_representatives(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mixture uses them, within a budget of
    the tokens that are there."""
    columns = docs.columns
    return mixing.mix(docs).select(*[F.col(f"`{c}`") for c in columns])


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``piece_ids`` of every text (an input column of that name is
    replaced)."""
    return docs.withColumn("piece_ids", piece_codec.encode_pieces(F.col("text"), tokenizer_path("piece_bpe_32k.model")))


STAGES = [
    ("quality_rules", quality_rules_stage),
    ("quality_classifier", quality_classifier_stage),
    ("near_dedup", near_dedup_stage),
    ("mixing", mixing_stage),
    ("encoding", encoding_stage),
]

#: Compression, MinHash and Viterbi have no plain SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
