"""Tables laid out for lookups.

Rows are put in the order of an interleaved key: each of several columns becomes a small number, its place
among the column's quantiles, and the bits of these numbers take turns. Neighbours in that order are near
in every column, so a file covers a small box and its minima and maxima rule it out for most
ranges of any of the columns. Keys that have no useful range, such as order numbers, get bloom filters.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 6
ACCURACY = 10_000  # of the quantiles; bounds what a task and the driver hold of them


def boundaries(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list[Any]]:
    """For each column, numeric or of dates, the distinct values that part it in about ``2**bits`` equal shares."""
    shares = [i / 2**bits for i in range(1, 2**bits)]
    found = df.agg(*(F.percentile_approx(c, shares, ACCURACY).alias(c) for c in columns)).first()
    return {c: sorted(set(found[c] or ())) for c in columns}


def place(value: Column, cuts: Sequence[Any]) -> Column:
    """How many of the sorted cuts are at most the value, by halving; 0 for null."""

    def halve(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value >= F.lit(cuts[middle]), halve(middle + 1, high)).otherwise(halve(low, middle))

    return halve(0, len(cuts))


def interleaved(places: Sequence[Column], bits: int = BITS) -> Column:
    """The bits of the numbers by turns, highest first, as one number."""
    key = F.lit(0).cast("long")
    for bit in range(bits):
        for turn, number in enumerate(places):
            one = F.shiftright(number, bit).bitwiseAND(F.lit(1)).cast("long")
            key = key.bitwiseOR(F.shiftleft(one, bit * len(places) + turn))
    return key


def write_clustered(
    df: DataFrame,
    target: str,
    near: Sequence[str],
    keys: Sequence[str] = (),
    files: int | None = None,
    keys_per_row_group: int = 1_000_000,
    bits: int = BITS,
    **options: str,
) -> None:
    """Write a folder of parquet, clustered by the columns ``near``, with bloom filters on ``keys``.

    One pass finds the quantiles, one shuffle by range writes the files, as many as the session's
    adaptive execution makes unless ``files`` says so. Rows of one box are parted by a hash of the whole row, so a box with
    very many fills several files. Nulls lie with the smallest values. Fails if the target exists.
    """
    if bits * len(near) > 62 or not near:
        raise ValueError("the interleaved key has one to 62 bits")
    cuts = boundaries(df, near, bits)
    key = interleaved([place(F.col(c), cuts[c]) for c in near], bits)
    order = [key, F.xxhash64(*(F.col(f"`{c}`") for c in df.columns))]
    dealt = df.repartitionByRange(files, *order) if files else df.repartitionByRange(*order)
    writer = dealt.sortWithinPartitions(key).write.options(**options)
    for name in keys:
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{name}", str(keys_per_row_group))
    writer.parquet(target)


def lookup(table: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """The rows with one of the keys. Row groups whose bloom filter lacks all of them are not read."""
    return table.where(F.col(key).isin(list(values)))


def in_box(table: DataFrame, ranges: dict[str, tuple[Any, Any]]) -> DataFrame:
    """The rows with every column within its bounds, both inclusive; None leaves a side open."""
    for name, (low, high) in ranges.items():
        if low is not None:
            table = table.where(F.col(name) >= F.lit(low))
        if high is not None:
            table = table.where(F.col(name) <= F.lit(high))
    return table
