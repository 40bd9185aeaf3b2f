"""Silver written together with what it drops, and counted while it is written.

One pass over Bronze judges every row: it is kept, or it goes to quarantine with its reason. Both are
partitions of one table, so that no row is in neither or in both, and the quality counters are observed on the rows as the
write takes them: no table is read again to count.

Deduplication here must not forget the losers, so the filter that lets each task send one row per key does not apply.
A key is dealt over ``salts`` groups first, and the first rows of these meet: a key that holds a third of
all rows spreads over all of them, and ``salts`` rows meet at most. Incomplete rows are never ranked, and rows whose key
does not repeat are not even shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from goldpan.operators import quality, sinks
from goldpan.operators.silver import (
    MOST_BROADCAST,
    in_arrival_order,
    missing_reasons,
    silver_projection,
    split_by_repeated_keys,
)
from goldpan.plans.medallion import Medallion
from goldpan.schema import CRITICAL_COLUMNS, NATURAL_KEY, SILVER_COLUMNS

SALTS = 1024
DUPLICATE = "duplicate_key"
OUTCOME_PARTITION = ("outcome", "batch_id")


def judge(bronze: DataFrame, salts: int = SALTS) -> DataFrame:
    """Every Bronze row in Silver's form with ``reason``, why Silver drops it, NULL where it stays.

    The rows that stay are those of a full refresh. Reasons are those of ``missing_reasons``, or
    ``duplicate_key`` for a complete row that is not the first of its key; equal rows are rows of their own.
    """
    order = in_arrival_order(SILVER_COLUMNS, NATURAL_KEY)
    complete, number, salt, near, far = F.col("_missing") == "", *map(F.col, ("_number", "_salt", "_near", "_far"))
    rows = bronze.select(
        *silver_projection(bronze), missing_reasons(bronze).alias("_missing"), F.monotonically_increasing_id().alias("_number")
    )
    dealt = rows.withColumn("_salt", F.when(complete, F.pmod(number, F.lit(salts))).otherwise(number))
    ranked = dealt.withColumn("_near", F.row_number().over(Window.partitionBy(*NATURAL_KEY, complete, salt).orderBy(*order)))
    # The first rows of all salts share group -1; every other row is a group by itself.
    met = ranked.withColumn("_meets", F.when(complete & (near == 1), -1).otherwise(number))
    final = met.withColumn("_far", F.row_number().over(Window.partitionBy(*NATURAL_KEY, "_meets").orderBy(*order)))
    reason = F.when(~complete, F.col("_missing")).when((near > 1) | (far > 1), DUPLICATE)
    return final.select(*SILVER_COLUMNS, reason.alias("reason"))


def judge_stored(bronze: DataFrame, salts: int = SALTS, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """The rows of ``judge`` over a stored table, where only rows of repeated keys are shuffled. Bronze is read three times."""
    parts = split_by_repeated_keys(bronze, NATURAL_KEY, most_broadcast)
    if parts is None:
        return judge(bronze, salts)
    alone, repeated = parts
    missing = missing_reasons(bronze)
    judged = alone.select(*silver_projection(bronze), F.when(missing != "", missing).alias("reason"))
    return judged.unionByName(judge(repeated, salts))


def judged_of(lake: Medallion) -> str:
    """Where a lake's judged rows are."""
    return f"{lake.root}/silver/judged_sales" if "/" in lake.root else f"{lake.silver}_judged"


def silver_of(lake: Medallion) -> DataFrame:
    """The rows that stay; quarantined files are not read."""
    return lake.read(judged_of(lake)).where("outcome = 'kept'").select(*SILVER_COLUMNS)


def quarantine_of(lake: Medallion) -> DataFrame:
    """The rows that Silver dropped, each with its reason; no other file is read."""
    return lake.read(judged_of(lake)).where("outcome = 'quarantined'").select(*SILVER_COLUMNS, "reason")


def quarantine_summary(quarantined: DataFrame) -> DataFrame:
    """Rows by batch and reason."""
    counts = quarantined.groupBy("batch_id", "reason").agg(F.count("*").alias("records"))
    return counts.orderBy("batch_id", "reason")


@dataclass(frozen=True)
class Audit:
    """What was counted while Silver was written."""

    lake: Medallion
    counts: dict[str, int]

    def _frame(self, *names: str) -> DataFrame:
        values = [tuple(self.counts[n] for n in names)]
        return self.lake.spark.createDataFrame(values, ", ".join(f"{n.removeprefix('kept_')} long" for n in names))

    def quality_checks(self) -> DataFrame:
        """The columns of ``quality.run_quality_checks`` over Silver."""
        nulls = (f"kept_null_{c}" for c in CRITICAL_COLUMNS)
        return self._frame(*nulls, "negative_sales", "invalid_quantity", "invalid_discount", "kept_total_records")

    def filter_rate(self) -> DataFrame:
        """The columns of ``quality.filter_rate``."""
        landed, dropped = F.col("bronze_records"), F.col("filtered_records")
        counts = self._frame("bronze_records", "silver_records", "filtered_records")
        return counts.withColumn("filtered_pct", F.round(F.try_divide(dropped * 100.0, landed), 2))

    def reasons(self) -> dict[str, int]:
        """Quarantined rows by what is wrong with them; a row that lacks two columns counts for both."""
        return {n.removeprefix("reason_"): v for n, v in self.counts.items() if n.startswith("reason_")}


def _counters() -> list[Column]:
    kept = F.col("reason").isNull()
    reasons = F.split("reason", ",")
    kinds = [f"{kind}_{c}" for c in CRITICAL_COLUMNS for kind in ("null", "unreadable")]
    return [
        F.count("*").alias("bronze_records"),
        F.count_if(kept).alias("silver_records"),
        F.count_if(kept).alias("kept_total_records"),
        F.count_if(~kept).alias("filtered_records"),
        *(F.count_if(kept & F.col(c).isNull()).alias(f"kept_null_{c}") for c in CRITICAL_COLUMNS),
        F.count_if(kept & quality.negative_sales()).alias("negative_sales"),
        F.count_if(kept & quality.invalid_quantity()).alias("invalid_quantity"),
        F.count_if(kept & quality.invalid_discount()).alias("invalid_discount"),
        *(F.count_if(F.array_contains(reasons, kind)).alias(f"reason_{kind}") for kind in (*kinds, DUPLICATE)),
    ]


def run_silver_audited(lake: Medallion, salts: int = SALTS) -> Audit:
    """Write what stays and what goes from all of Bronze, and return what was counted meanwhile.

    The counters sit above every shuffle, in the tasks that write: Spark takes the counts of such a task once, however
    often executors are lost.
    """
    seen = Observation("silver")
    judged = judge_stored(lake.read(lake.bronze), salts).observe(seen, *_counters())
    outcome = F.when(F.col("reason").isNull(), "kept").otherwise("quarantined").alias("outcome")
    sinks.create_or_replace_table(judged.select("*", outcome), judged_of(lake), OUTCOME_PARTITION)
    return Audit(lake, dict(seen.get))
