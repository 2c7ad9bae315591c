"""Corpus pipeline: rules, near copies, benchmark leaks, personal data, mixture.

Every stage gets what its predecessor kept, as a table read from Parquet.  All but
the last return the columns of ``documents``; the last adds ``copy``, the running
number of a document's repetitions.  Null, empty and repeated rows are treated as the
operators' docstrings say; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fieldloom.llm import mixing, personal, quality_rules, simhash, tiling
from fieldloom.llm.common import table
from fieldloom.shared import materialize


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    return simhash.keep_one(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return tiling.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def private_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in brackets (n_chars stays as it was)."""
    return personal.redacted(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks for."""
    return mixing.emitted(docs)


STAGES = [("quality rules", rules), ("near copies", near_copies), ("benchmark leaks", benchmark_leaks),
          ("personal data", private_spans), ("mixture", mixture)]

#: certified cutoffs, fingerprints and tilings are beyond SQL; tests/llm holds a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
