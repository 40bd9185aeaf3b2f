"""Distinct orders by group, kept up to date batch by batch without reading older batches.

Distinct counts do not add up over batches, bitmaps of order numbers do. Every order gets a dense number within a hash
bucket, written to a dictionary when a batch first brings it and never changed. A batch is then summed up once: its sums
by group, and one bitmap by group and 32,768 numbers of a bucket. Merging ors the bitmaps and adds what they count: exact.

What a merge reads grows with groups times numbered orders, at an eighth of a byte each, not with order lines. So this is for
groups that are few, such as regions, categories, segments and months. A batch also keeps a sketch by group,
whose merged count has a relative standard error of about ``SKETCH_ERROR``, for when that is enough.

A batch that is summed up again, also after a failure half way, replaces itself; orders keep the numbers they have. Null
orders are not counted, as in SQL. One batch at a time may be added to a lake.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from goldpan.functions.measures import total_profit, total_quantity, total_sales
from goldpan.operators import sinks
from goldpan.plans.medallion import Medallion
from goldpan.storage import materialize

BUCKETS = 64
SKETCH_BITS = 14
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)

# Reports, and the columns that each groups by.
REPORTS = {
    "by_category": ("category",),
    "by_region": ("region",),
    "by_segment": ("segment",),
    "by_month": ("year", "month"),
}

_NUMBERS = "order_id string, order_no long, order_bucket int, added_by string"
_PIECE = ("order_bucket", "piece")


def _target(lake: Medallion, table: str) -> str:
    return f"{lake.root}/distinct_orders/{table}" if "/" in lake.root else f"{lake.root}_distinct_orders_{table}"


def dictionary_of(lake: Medallion) -> DataFrame:
    """The numbers of all orders so far: order_id, order_bucket, order_no (from 1 in each bucket), added_by."""
    target = _target(lake, "numbers")
    if not sinks.table_exists(lake.spark, target):
        return lake.spark.createDataFrame([], _NUMBERS)
    return lake.read(target).select("order_id", "order_no", "order_bucket", "added_by")


def number_orders(lake: Medallion, orders: DataFrame, batch_id: str, buckets: int = BUCKETS) -> None:
    """Give the orders that have none the next numbers of their buckets. Only the buckets they fall into are read.

    New orders of one bucket are numbered in one task: ``buckets`` should grow with the orders of a batch, and
    must be the same in every call for one lake.
    """
    bucket = F.pmod(F.xxhash64("order_id"), F.lit(buckets)).cast("int").alias("order_bucket")
    own = orders.where("order_id is not null").select("order_id", bucket).distinct()
    known = dictionary_of(lake)
    new = materialize(own.join(known.select("order_id", "order_bucket"), ["order_id", "order_bucket"], "left_anti"), "new_orders")
    touched = [r.order_bucket for r in new.select("order_bucket").distinct().collect()]  # the number of buckets at most
    if not touched:
        return
    known = known.where(F.col("order_bucket").isin(touched))
    last = known.groupBy("order_bucket").agg(F.max("order_no").alias("last"))
    place = F.row_number().over(Window.partitionBy("order_bucket").orderBy("order_id"))
    number = (F.coalesce("last", F.lit(0)) + place).cast("long").alias("order_no")
    entries = new.join(last, "order_bucket", "left").select("order_id", number, "order_bucket", F.lit(batch_id).alias("added_by"))
    # What a failed or earlier run of this batch has numbered stays, in the same partitions.
    kept = known.where(F.col("added_by") == batch_id)
    sinks.replace_partitions(
        materialize(entries.unionByName(kept), "order_numbers"), _target(lake, "numbers"), ("order_bucket", "added_by")
    )


def add_batch(lake: Medallion, number: int, buckets: int = BUCKETS) -> None:
    """Sum up one batch of Silver for all reports. Of Silver, only that batch's partition is read."""
    batch_id = f"batch_{number}"
    silver = lake.read(lake.silver).where(F.col("batch_id") == batch_id)
    dated = silver.withColumns({"year": F.year("order_date"), "month": F.month("order_date")})
    groups = sorted({c for keys in REPORTS.values() for c in keys})
    number_orders(lake, silver, batch_id, buckets)
    # Lines of one order and group are one row before the join, however many there are.
    pairs = dated.where("order_id is not null").select("order_id", *groups).distinct()
    numbered = materialize(pairs.join(dictionary_of(lake), "order_id").select("order_bucket", "order_no", *groups), "numbered")
    for name, keys in REPORTS.items():
        sums = dated.groupBy(*keys).agg(
            *(F.sum(c).alias(c) for c in ("sales", "profit", "quantity")),
            F.hll_sketch_agg("order_id", F.lit(SKETCH_BITS)).alias("sketch"),
        )
        bits = numbered.groupBy(*keys, "order_bucket", F.bitmap_bucket_number("order_no").alias("piece")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("order_no")).alias("bits")
        )
        sinks.replace_one_partition(bits, _target(lake, f"{name}_bits"), "batch_id", batch_id)
        sinks.replace_one_partition(sums, _target(lake, f"{name}_sums"), "batch_id", batch_id)


def report(lake: Medallion, name: str, sketch: bool = False) -> DataFrame:
    """Sums and distinct orders by group over all batches added so far, from what was stored for each.

    With ``sketch`` the bitmaps are not read and ``order_count`` is an estimate.
    """
    keys = REPORTS[name]
    stored = lake.read(_target(lake, f"{name}_sums"))
    measures = [total_sales(), total_profit(), total_quantity()]
    if sketch:
        estimate = F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("order_count")
        return stored.groupBy(*keys).agg(*measures, estimate)
    bits = lake.read(_target(lake, f"{name}_bits"))
    pieces = bits.groupBy(*keys, *_PIECE).agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("orders"))
    # A union rather than a join: a group may be null, or have no orders.
    counted = pieces.groupBy(*keys).agg(F.sum("orders").alias("orders"))
    summed = stored.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in ("sales", "profit", "quantity")))
    both = summed.unionByName(counted, allowMissingColumns=True)
    return both.groupBy(*keys).agg(*measures, F.coalesce(F.sum("orders"), F.lit(0)).alias("order_count"))
