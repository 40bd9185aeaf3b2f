"""Documents to a training mix: five stages, each over all that its predecessor kept.

``run`` writes what a stage returns to the folder all executors share and reads it back for the next,
so a lost executor repeats no earlier stage.

Defined results: a null text is empty, scores as clean, is a copy of other empty texts, has no shingles and no words, and is
taken by the mix without adding any; very long texts go through every stage whole; among equal texts the largest doc_id
stays, among near copies the smallest; rows that agree in text and id are one; a null source is a source; an empty table
gives an empty result; further columns, whatever their names, pass through all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldpan.llm import decontaminate, exact_dedup, mixing, near_dedup, toxicity
from goldpan.llm.common import table
from goldpan.storage import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; the labels of all labelled documents teach the score."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), F.lit(True))
    return toxicity.drop_toxic(docs, model)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id stays."""
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest doc_id."""
    return near_dedup.drop_near_copies(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a ten-word window of a benchmark item, or a whole shorter item, go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]

# A trained score and connected components of similar sets are beyond SQL; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
