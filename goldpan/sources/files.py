"""What lies in storage: landed files, and the data files behind a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def landed_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Files under ``folder`` with their size. Only the listing is read, never the content."""
    return (
        spark.read.format("binaryFile")
        .options(pathGlobFilter=pattern, recursiveFileLookup=True)
        .load(folder)
        .select("path", F.col("length").alias("size_bytes"))
    )


def data_files(table: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """One row per parquet file of a table: path, format, rows, bytes and partition values.

    Needs the frame as it was read. No data column is touched, so row counts come from the
    parquet footers.
    """
    per_file = table.groupBy(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("file_size_in_bytes"),
        *partition_by,
    ).agg(F.count("*").alias("record_count"))
    columns = [
        "file_path",
        F.upper(F.regexp_extract("file_path", r"\.([^./]+)$", 1)).alias("file_format"),
        "record_count",
        "file_size_in_bytes",
    ]
    if partition_by:
        columns.append(F.struct(*partition_by).alias("partition"))
    return per_file.select(*columns)


def files_per_partition(files: DataFrame, field: str = "ingestion_date") -> DataFrame:
    """File count, rows and bytes per value of one partition field, newest first."""
    return (
        files.groupBy(F.col(f"partition.{field}").alias(field))
        .agg(
            F.count("*").alias("file_count"),
            F.sum("record_count").alias("total_records"),
            F.sum("file_size_in_bytes").alias("total_size_bytes"),
        )
        .orderBy(F.desc(field))
    )


def partitions(table: DataFrame, partition_by: tuple[str, ...]) -> DataFrame:
    """Row and file counts per combination of partition values."""
    return (
        data_files(table, partition_by)
        .groupBy("partition")
        .agg(F.sum("record_count").alias("record_count"), F.count("*").alias("file_count"))
        .select("partition.*", "record_count", "file_count")
    )
