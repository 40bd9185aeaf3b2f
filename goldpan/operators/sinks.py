"""Plain table sinks. A target with a slash is a folder of parquet, anything else a table name."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

# The characters that Spark escapes in the name of a partition's folder.
_ESCAPED = r"""[\x01-\x1f"#%'*/:=?\\\x7f{\[\]^]"""

# What Bronze is partitioned by where batches may land again.
BATCH_PARTITION = ("ingestion_date", "batch_id")


# Partitions that a task writes side by side; it sorts its rows by partition only where it meets more.
WRITERS = 4


@contextmanager
def side_by_side(spark: SparkSession) -> Iterator[None]:
    """Without this a task sorts all its wide rows by partition before it writes the first, in memory that grows with them.

    Spark has it as a session setting only, so that is put back afterwards.
    """
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(max(WRITERS, int(before))))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _save(df: DataFrame, target: str, mode: str, partition_by: Sequence[str]) -> None:
    writer = df.write.format("parquet").mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with side_by_side(df.sparkSession):
        if "/" in target:
            writer.save(target)
        else:
            writer.saveAsTable(target)


def read_table(spark: SparkSession, target: str) -> DataFrame:
    """A table by name or folder; a column that only later files of a folder have is NULL before."""
    return spark.read.option("mergeSchema", True).parquet(target) if "/" in target else spark.table(target)


def table_exists(spark: SparkSession, target: str) -> bool:
    if "/" not in target:
        return spark.catalog.tableExists(target)
    try:
        spark.read.parquet(target)
    except AnalysisException:
        return False
    return True


def create_bronze_table(df: DataFrame, target: str) -> None:
    """Create, partitioned by ingestion date. Fails if the table exists."""
    _save(df, target, "errorifexists", ["ingestion_date"])


def append_to_bronze(df: DataFrame, target: str) -> None:
    _save(df, target, "append", ["ingestion_date"])


def create_table(df: DataFrame, target: str, partition_by: Sequence[str] = ()) -> None:
    """Create a table. Fails if it exists."""
    _save(df, target, "errorifexists", partition_by)


def create_or_replace_table(df: DataFrame, target: str, partition_by: Sequence[str] = ()) -> None:
    """Create or overwrite. ``df`` must not read the target."""
    _save(df, target, "overwrite", partition_by)


def replace_partitions(df: DataFrame, target: str, partition_by: Sequence[str]) -> None:
    """Put the partitions that ``df`` has in place of their old content and leave the others alone.

    Landing a batch twice, or again after a failed write, leaves it there once.
    """
    spark = df.sparkSession
    named = "/" not in target
    if named and not table_exists(spark, target):
        create_table(df, target, partition_by)
        return
    path = target
    if named:
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {target}")
        path = described.where("col_name = 'Location'").first().data_type
        df = df.select(*(f"`{c}`" for c in spark.table(target).columns))
    with side_by_side(spark):
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)
    if named:
        spark.catalog.recoverPartitions(target)
        spark.catalog.refreshTable(target)


def replace_one_partition(df: DataFrame, target: str, column: str, value: str) -> None:
    """Put the rows in place of the one partition, also where there are none left. ``df`` must not read the target."""
    spark = df.sparkSession
    if "/" in target:
        escaped = re.sub(_ESCAPED, lambda m: f"%{ord(m[0]):02X}", value)
        df.drop(column).write.mode("overwrite").parquet(f"{target}/{column}={escaped}")
        return
    if not table_exists(spark, target):
        create_table(df.limit(0), target, [column])
    columns = [c for c in spark.table(target).columns if c != column]
    spark.sql(
        f"INSERT OVERWRITE TABLE {target} PARTITION ({column} = :value) SELECT {', '.join(f'`{c}`' for c in columns)} FROM {{rows}}",
        args={"value": value},
        rows=df,
    )
