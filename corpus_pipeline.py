"""The corpus pipeline: five stages, each one operator on all rows that the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from groundhold.llm import content_sort, mixing, packing, risk_quality, set_sketch
from groundhold.llm.common import materialize, table
from groundhold.llm.queries import _tokenizer


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or a certified cutoff reject go."""
    return risk_quality.drop_rejected(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal up to white space, the row with the smallest id stays."""
    return content_sort.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked at 0.8 on five-word shingles, the one with the smallest id stays."""
    return set_sketch.drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every pass of the mix over a document becomes a row with the words it takes."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed documents as token pieces placed in sequences."""
    return packing.pack(docs, **_tokenizer())


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("mix", mix), ("pack", pack)]

# Registers, sketches and tokenization have no SQL form. Tests run all stages and check the packed lengths; near-duplicates have a
# brute-force test of their own, the other stages are not compared with one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn on ``documents``; each result is written to the scratch folder and read by the next stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
