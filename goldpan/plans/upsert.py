"""Silver kept equal to a full refresh, batch by batch, without rereading what did not change.

A narrow index says which batch each natural key came in first. It is only added to: an upsert writes the keys
that its batch wins, so an earlier batch that lands late adds entries that beat older ones. Silver of a batch
is always the cleaned batch, restricted to the keys it owns: a function of Bronze and the index. An
upsert that failed half way can therefore be repeated, and batches may come in any order.

The index is partitioned by a hash of the key; only the partitions that the new keys fall into are read. Silver
is partitioned by batch; only the new batch, and batches that lose keys to it, are written. Only keys are shuffled, and the
rows of keys that repeat within the batch.

A batch that lands again with the same rows changes nothing. If it lands with other rows, keys it no longer has may
have beaten rows of other batches: refresh Silver in full and call ``rebuild_index``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldpan.operators import sinks
from goldpan.operators.silver import drop_incomplete, standardize_sales_columns, stored_to_silver
from goldpan.plans.medallion import Medallion
from goldpan.schema import CRITICAL_COLUMNS, NATURAL_KEY
from goldpan.storage import materialize

BUCKETS = 64
# Keys a batch lost that are broadcast, some 150 bytes each; beyond that its rows are shuffled to drop them.
MOST_LOST = 1_000_000
_ARRIVAL = ("ingestion_ts", "batch_id")
_INDEX_PARTITION = ("key_bucket", "added_by")


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64(*NATURAL_KEY), F.lit(buckets)).cast("int").alias("key_bucket")


def index_of(lake: Medallion) -> str:
    """Where the index of a lake's Silver is."""
    return f"{lake.silver}_index" if "/" not in lake.root else f"{lake.root}/silver/sales_index"


def _landed(lake: Medallion, batch_id: str) -> DataFrame:
    """One batch of Bronze. Only its partition is read."""
    return lake.read(lake.bronze).where(F.col("batch_id") == batch_id)


def clean_batch(lake: Medallion, batch_id: str) -> DataFrame:
    """One batch of Bronze in Silver's form, the first row of each of its keys."""
    return stored_to_silver(_landed(lake, batch_id))


def own_keys(lake: Medallion, batch_id: str, buckets: int) -> DataFrame:
    """The keys of a batch's complete rows with their arrival; a key may come several times."""
    narrow = (*NATURAL_KEY, *CRITICAL_COLUMNS, *_ARRIVAL)
    rows = drop_incomplete(standardize_sales_columns(_landed(lake, batch_id), columns=narrow))
    return rows.select(*NATURAL_KEY, F.struct(*_ARRIVAL).alias("own"), _bucket(buckets))


def first_arrivals(index: DataFrame) -> DataFrame:
    """For each key of the index the arrival (time, batch) that comes first."""
    return index.groupBy(*NATURAL_KEY).agg(F.min(F.struct(*_ARRIVAL)).alias("first"))


def touched(index: DataFrame, keys: DataFrame) -> DataFrame:
    """The index entries in the buckets that the keys fall into."""
    buckets = [r.key_bucket for r in keys.select("key_bucket").distinct().collect()]  # the number of buckets at most
    return index.where(F.col("key_bucket").isin(buckets))


def upsert_silver(lake: Medallion, number: int, buckets: int = BUCKETS) -> list[str]:
    """Bring Silver up to date with one landed batch; returns the batches that were written.

    ``buckets`` must be the same in every call for one lake.
    """
    batch_id = f"batch_{number}"
    index = index_of(lake)
    own = own_keys(lake, batch_id, buckets)
    first = F.lit(None).cast("struct<ingestion_ts: timestamp, batch_id: string>").alias("first")
    met = own.select("*", first)
    if sinks.table_exists(lake.spark, index):
        others = lake.read(index).where(F.col("batch_id") != batch_id)
        met = own.join(first_arrivals(touched(others, own)), list(NATURAL_KEY), "left")
    arrivals = met.groupBy(*NATURAL_KEY).agg(
        F.min("own").alias("own"), F.first("first").alias("first"), F.first("key_bucket").alias("key_bucket")
    )
    keys = materialize(arrivals.withColumn("won", F.expr("first is null or own < first")), "keys")
    won = keys.where("won")
    beaten = [r[0] for r in won.where("first is not null").select("first.batch_id").distinct().collect()]  # batches
    entries = won.select(*NATURAL_KEY, "own.*", "key_bucket", F.lit(batch_id).alias("added_by"))
    sinks.replace_partitions(entries, index, _INDEX_PARTITION)
    written = [batch_id, *sorted(beaten)]
    for name in written:
        _write_owned(lake, name, keys.where("not won") if name == batch_id else None, buckets)
    return written


def _write_owned(lake: Medallion, batch_id: str, lost: DataFrame | None, buckets: int) -> None:
    """Write Silver of one batch: its cleaned rows but for the keys that by the index it does not own."""
    if lost is None:
        keys = own_keys(lake, batch_id, buckets)
        first = first_arrivals(touched(lake.read(index_of(lake)), keys))
        owned = F.coalesce(F.col("first.batch_id") == batch_id, F.lit(False))
        lost = materialize(keys.join(first, list(NATURAL_KEY), "left").where(~owned).select(*NATURAL_KEY).distinct(), "lost")
    rows = clean_batch(lake, batch_id)
    few = lost.count() <= MOST_LOST
    lost = lost.select(*NATURAL_KEY).hint("broadcast" if few else "merge")
    kept = rows.join(lost, list(NATURAL_KEY), "left_anti").select(*rows.columns)
    sinks.replace_one_partition(kept, lake.silver, "batch_id", batch_id)


def rebuild_index(lake: Medallion, buckets: int = BUCKETS) -> None:
    """Write the index anew from stored Silver, as one set of entries, for upserts to go on from."""
    silver = lake.read(lake.silver)
    entries = silver.select(*NATURAL_KEY, *_ARRIVAL, _bucket(buckets), F.lit("rebuild").alias("added_by"))
    sinks.create_or_replace_table(entries, index_of(lake), _INDEX_PARTITION)
