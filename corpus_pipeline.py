"""Corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a frame, which is written as Parquet and read again as the next one's
docs. All stages but the last return documents with the columns they came with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stayline.llm.decontaminate import drop_contaminated
from stayline.llm.language_mix import keep_identified
from stayline.llm.line_dedup import drop_repeated_lines
from stayline.llm.packing import pack_documents
from stayline.llm.simhash import drop_near_duplicates
from stayline.llm.tables import read, stored, tuned_for_text


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language that holds at least half of them."""
    return keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stand earlier in the corpus; those that lose every line go."""
    return drop_repeated_lines(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents with their places in sequences."""
    return pack_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", packing),
]

#: The stages learn, link and pack; SQL cannot express them. A test holds run() on planted documents against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table `documents`."""
    docs = read(tuned_for_text(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
