"""The corpus pipeline: documents of good quality and without toxicity, one of each near-duplicate group, mixed by
source and encoded.

Every stage is a function of (spark, docs, sf_dir); its result is written as Parquet and read again as the next
one's documents, so a stage can be repeated when executors are lost. Null and empty texts are scored like any
other, repeated rows are judged alike, an empty table passes through empty, and extra columns are carried to the
last stage, whose columns are its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm import mixing, quality, simhash, toxicity, viterbi
from stratalake.llm.common import load, staged, unused

ORACLE_SQL = None  # trained scores and fingerprints have no SQL form; tests/llm holds the stages against brute force


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the classifier's threshold; a score equal to it stays."""
    name = unused(docs, "_quality")
    scored = quality.with_score(docs, load(spark, sf_dir, "labels"), name)
    return scored.where(F.col(name) >= quality.THRESHOLD).select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the classifier's threshold; a score equal to it goes."""
    name = unused(docs, "_toxicity")
    scored = toxicity.with_score(docs, load(spark, sf_dir, "labels"), name)
    return scored.where(F.col(name) < toxicity.THRESHOLD).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints: three-word shingles, two bits.

    The one with the smallest id stays, ids that are null come last, ties go by text; repeated rows leave one.
    Null and empty texts share fingerprint zero and are one group.
    """
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often and in the order in which the mix reads them; those without words once."""
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document of the mix, instead of its text; none for null and empty texts."""
    coded = viterbi.encode(docs, keep=["doc_id", "lang", "source"])
    return coded.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality classifier", drop_low_quality),
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_duplicates),
    ("mixing to target weights", mix_sources),
    ("sentencepiece encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the last one's rows."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
