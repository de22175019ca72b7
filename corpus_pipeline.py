"""From raw documents to packed training batches: five stages, each over all that its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelweave.llm import host_quality, line_runs, mixing, near_duplicates, packing
from panelweave.llm.shared import table
from panelweave.session import stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and, on strict hosts, every rule."""
    return host_quality.keep(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many of them share."""
    return line_runs.thinned(docs)


def duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return near_duplicates.keep_one(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out until each source has its share."""
    return mixing.mix(docs)


def batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bucket, batch and slot of every document of the mix."""
    return packing.packed(docs)


STAGES = [("quality", quality), ("lines", lines), ("duplicates", duplicates), ("mixture", mixture), ("batches", batches)]
#: SimHash components and random rounding are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
