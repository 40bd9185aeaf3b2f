"""Data-quality counters, each a single pass over its table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldpan.functions.measures import row_count
from goldpan.schema import CRITICAL_COLUMNS, RAW_NAME


def negative_sales(column: str = "sales") -> Column:
    return F.col(column) < 0


def invalid_quantity(column: str = "quantity") -> Column:
    return F.col(column) <= 0


def invalid_discount(column: str = "discount") -> Column:
    return (F.col(column) < 0) | (F.col(column) > 1)


def _null_counters(raw_names: bool) -> list[Column]:
    return [
        F.count_if(F.col(f"`{RAW_NAME[c] if raw_names else c}`").isNull()).alias(f"null_{c}")
        for c in CRITICAL_COLUMNS
    ]


def _invalid_counters() -> list[Column]:
    return [
        F.count_if(negative_sales()).alias("negative_sales"),
        F.count_if(invalid_quantity()).alias("invalid_quantity"),
        F.count_if(invalid_discount()).alias("invalid_discount"),
    ]


def run_quality_checks(silver: DataFrame) -> DataFrame:
    """Nulls in critical columns, negative sales, invalid quantities and discounts, all rows."""
    return silver.agg(*_null_counters(False), *_invalid_counters(), row_count("total_records"))


def bronze_null_counts(bronze: DataFrame) -> DataFrame:
    return bronze.agg(row_count("total_records"), *_null_counters(True))


def silver_null_counts(silver: DataFrame) -> DataFrame:
    return silver.agg(row_count("total_records"), *_null_counters(False))


def silver_invalid_counts(silver: DataFrame) -> DataFrame:
    return silver.agg(*_invalid_counters())


def null_counts_by_layer(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """The null counters of both layers, one row each."""
    rows = [
        bronze.agg(*_null_counters(True)).withColumn("layer", F.lit("bronze")),
        silver.agg(*_null_counters(False)).withColumn("layer", F.lit("silver")),
    ]
    return rows[0].unionByName(rows[1])


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per named table."""
    counts = [
        df.agg(row_count("record_count")).select(F.lit(name).alias("table_name"), "record_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def filter_rate(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """How many rows Silver dropped, and their share in percent."""
    counts = table_counts({"bronze": bronze, "silver": silver})
    in_layer = {
        layer: F.sum(F.when(F.col("table_name") == layer, F.col("record_count")))
        for layer in ("bronze", "silver")
    }
    dropped = F.col("bronze_records") - F.col("silver_records")
    return counts.agg(
        in_layer["bronze"].alias("bronze_records"), in_layer["silver"].alias("silver_records")
    ).select(
        "bronze_records",
        "silver_records",
        dropped.alias("filtered_records"),
        F.round(F.try_divide(dropped * 100.0, F.col("bronze_records")), 2).alias("filtered_pct"),
    )


def batch_quality_summary(bronze: DataFrame) -> DataFrame:
    """Rows and issues of every landed batch."""
    return (
        bronze.groupBy("batch_id")
        .agg(
            row_count("records"),
            F.count_if(F.col("Sales").isNull()).alias("null_sales"),
            F.count_if(F.col("Product ID").isNull()).alias("null_product_id"),
            F.count_if(invalid_discount("Discount")).alias("invalid_discount"),
            F.count_if(invalid_quantity("Quantity")).alias("invalid_quantity"),
        )
        .orderBy("batch_id")
    )
