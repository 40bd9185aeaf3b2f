"""Bronze: a batch as it came, plus where and when it came from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# The lineage of a batch its caller says nothing about.
DEFAULT_FILE = "superstore_sales.csv"
DEFAULT_SYSTEM = "superstore_csv"
DEFAULT_BATCH = "batch_001"


def enrich_with_metadata(
    df: DataFrame,
    source_file: str = DEFAULT_FILE,
    source_system: str = DEFAULT_SYSTEM,
    batch_id: str = DEFAULT_BATCH,
    arrived_at: Column | None = None,
) -> DataFrame:
    """Add the five lineage columns. ``arrived_at`` replaces the clock, for replays and tests."""
    arrival = F.current_timestamp() if arrived_at is None else arrived_at
    return df.withColumns(
        {
            "ingestion_date": F.to_date(arrival),
            "ingestion_ts": arrival,
            "source_file": F.lit(source_file),
            "source_system": F.lit(source_system),
            "batch_id": F.lit(batch_id),
        }
    )
