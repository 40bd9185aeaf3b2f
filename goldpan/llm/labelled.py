"""Labelled documents, all or a bounded sample, and the row that a crc32 remainder holds out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldpan.llm.common import id_and_text


def held_out(modulus: int, remainder: int, id_col: str = "doc_id") -> Column:
    """Whether the crc32 of the id as text leaves that remainder; a null id counts as empty text."""
    crc = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    return F.pmod(crc, F.lit(modulus)) == remainder


def _known(labels: DataFrame, label_col: str, learn: Column) -> DataFrame:
    return (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label_col).isin(0, 1) & learn)
        .select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    )


def labelled(labels: DataFrame, label_col: str, learn: Column) -> DataFrame:
    """doc_id and label (0 or 1) of all rows that have both. Of rows that share an id the larger label counts."""
    return _known(labels, label_col, learn).groupBy("doc_id").agg(F.max("label").alias("label"))


def sample(labels: DataFrame, label_col: str, learn: Column, most_per_class: int) -> DataFrame:
    """doc_id and label (0 or 1) of at most ``most_per_class`` rows a class, in the order of a hash.

    Rows without id or label stay out. Of rows that share an id the larger label counts.
    """
    rows = _known(labels, label_col, learn)
    parts = [
        rows.filter(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_per_class)
        for value in (1, 0)
    ]
    both = reduce(DataFrame.unionByName, parts)
    return both.groupBy("doc_id").agg(F.max("label").alias("label"))


def texts_of(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """doc_id, label and text of the chosen rows; the choice is bounded, so it is sent to the texts."""
    return id_and_text(docs).join(F.broadcast(chosen), "doc_id")
