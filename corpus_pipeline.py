"""From documents to packed token ids: five stages, each over all that the one before has kept.

Documents the classifier rejects go; one document of each near-duplicate group
stays (word 5-shingles, similarity 0.8 or more); documents that hold a benchmark
item go; sources are mixed to their targets, so a document may come twice; the
texts become packed rows of token ids that name their documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trackstats.llm import decontaminate, mixing, near_dedup, packing, quality_model
from trackstats.llm.registry import table
from trackstats.llm.store import stored


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_model.without_rejected(docs, table(spark, sf_dir, "labels"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.drop_near_duplicates(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixture(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", classify), ("near_duplicates", deduplicate), ("decontamination", decontaminated),
    ("source_mixture", mix), ("token_ids", pack)]

#: SQL cannot express a trained network or a vocabulary; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed rows of the stages applied to ``documents``, each stage's rows written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {"pipeline": run}
ORACLES = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
