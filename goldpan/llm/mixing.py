"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected the same number of times: its source's target over the
words the source has. Within a source the expected copies are summed along the documents, ordered
by size, a random offset is added, and a document comes out once for each integer that its stretch
crosses. Order by size makes the words taken follow the target, not just the documents.

The sums are taken in three short steps, so that no task orders a whole source: over the sizes of
a source, over the salts of a size, and over the rows of a salt. A size has one salt for every
``PER_SALT`` documents, and a hash of id and text deals them out, so salts stay short however many
documents have one size, whatever their ids. Texts are read once: their sizes and hashes are written.

Defined results: a null text has no words, so it is taken without adding any; the null source is a
source and comes last; a null id sorts first, and rows of one id go by their hashes; repeated rows are rows of their
own; a very long text counts whole and may be taken twice like any other; a mix of no words has targets of
zero; an empty table gives an empty result; columns not asked for, whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldpan.llm.common import SPACE_RUN, whole_text
from goldpan.storage import materialize

PER_SALT = 100_000  # documents of one size that one task puts in order


def targets(sizes: DataFrame, weights: tuple[int, ...], share_num: int, share_den: int, most: int) -> DataFrame:
    """``source_key``, ``source`` and ``source_size``, one row a source, to their targets.

    Sources by code point, null last, take ``weights`` in turn and share ``share_num/share_den``
    of all words. A target stops at ``most`` times its source's size and the rest is shared again
    until none is above. That ends where the sources with the smallest ``size / weight`` are full
    and the others share what is left, so one running sum in that order finds it. Only integers
    are compared.
    """
    everything = Window.partitionBy()
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, weights)), ((rank - 1) % len(weights) + 1).cast("int"))
    ranked = sizes.select("*", rank.alias("rank"), weight.cast("long").alias("weight"))
    filling = Window.orderBy(F.col("source_size") / F.col("weight"), "rank")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    left = ranked.select(
        "*",
        (
            share_num * F.sum("source_size").over(everything)
            - share_den * most * F.coalesce(F.sum("source_size").over(before), F.lit(0))
        ).alias("words_left"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("weight_left"),
    )
    fits = F.col("weight") * F.col("words_left") <= share_den * most * F.col("source_size") * F.col("weight_left")
    level = F.min(F.when(fits, F.struct(F.col("source_size") / F.col("weight"), "rank", "words_left", "weight_left")))
    share = (F.col("weight") * F.col("level.words_left")).cast("double") / (
        share_den * F.col("level.weight_left")
    ).cast("double")
    full = (most * F.col("source_size")).cast("double")
    open_ = F.col("source_size") / F.col("weight") >= F.col("level.col1")
    return left.withColumn("level", level.over(everything)).select(
        "source_key",
        "source",
        "source_size",
        F.when(open_, F.least(share, full)).otherwise(full).alias("target"),
    )


def offset(seed: str, key: Column) -> Column:
    """A number in [0, 1) for each source, the same in every run."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), key)), 1, 8), 16, 10).cast("double") / 4294967296.0


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """One narrow row per document: doc_id, source, source_key, size, and a hash of id and text."""
    identity = F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("n")), whole_text(text_col))
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("n")).alias("source_key"),
        F.regexp_count(whole_text(text_col), F.lit(SPACE_RUN)).cast("long").alias("size"),
        F.conv(F.substring(F.md5(identity), 1, 8), 16, 10).cast("long").alias("spread"),
    )


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (3, 1, 2),
    share: tuple[int, int] = (3, 2),
    most: int = 2,
    seed: str = "mix",
    per_salt: int = PER_SALT,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, copies, taken (words)."""
    narrow = materialize(sized(docs, id_col, text_col, source_col), "sizes")
    by_size = narrow.groupBy("source_key", "source", "size").agg(F.count(F.lit(1)).alias("n"))
    salts = by_size.select("source_key", "size", F.ceil(F.col("n") / per_salt).alias("salts"))
    salted = narrow.join(salts, ["source_key", "size"]).select(
        "doc_id", "source_key", "size", "spread", (F.col("spread") % F.col("salts")).alias("salt")
    )
    # Dealt by salt, too: the join's own partitioning would leave all rows of a size in one task.
    salted = salted.repartition("source_key", "size", "salt")
    groups = salted.groupBy("source_key", "size", "salt").agg(F.count(F.lit(1)).alias("n"))
    goal = targets(
        by_size.groupBy("source_key", "source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size")),
        weights,
        *share,
        most,
    )
    sizes_before = Window.partitionBy("source_key").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    salts_before = (
        Window.partitionBy("source_key", "size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    )
    sums = by_size.select(
        "source_key", "size", F.coalesce(F.sum("n").over(sizes_before), F.lit(0)).alias("smaller")
    ).join(goal.drop("source"), "source_key")
    groups = groups.select(
        "source_key", "size", "salt", F.coalesce(F.sum("n").over(salts_before), F.lit(0)).alias("earlier")
    ).join(sums, ["source_key", "size"])
    row = F.row_number().over(Window.partitionBy("source_key", "size", "salt").orderBy("doc_id", "spread"))
    placed = salted.select("doc_id", "source_key", "size", "salt", row.alias("row")).join(
        groups, ["source_key", "size", "salt"]
    )
    place = F.col("smaller") + F.col("earlier") + F.col("row")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    start = offset(seed, F.col("source_key"))
    crossed = F.floor(rate * place + start) - F.floor(rate * (place - 1) + start)
    return placed.withColumn("copies", F.least(crossed, F.lit(most)).cast("long")).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )
