"""Gold: business aggregates of Silver. Readers sort; the tables themselves carry no order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldpan.functions.measures import (
    line_count,
    money_average,
    total_profit,
    total_quantity,
    total_sales,
)


def create_sales_by_category_region(silver: DataFrame) -> DataFrame:
    return silver.groupBy("category", "region").agg(
        total_sales(), total_profit(), total_quantity(), line_count()
    )


def create_sales_by_segment(silver: DataFrame) -> DataFrame:
    return silver.groupBy("segment").agg(
        total_sales(), total_profit(), money_average("sales", "avg_order_value"), line_count()
    )


def create_top_products(silver: DataFrame) -> DataFrame:
    return silver.groupBy("category", "sub_category", "product_name").agg(
        total_sales(), total_profit(), total_quantity()
    )


# Table name of each Gold aggregate and the function that computes it.
GOLD_TABLES = {
    "sales_by_category_region": create_sales_by_category_region,
    "sales_by_segment": create_sales_by_segment,
    "top_products": create_top_products,
}

_KEYS = {
    "sales_by_category_region": ("category", "region"),
    "sales_by_segment": ("segment",),
    "top_products": ("category", "sub_category", "product_name"),
}


def gold_parts(silver: DataFrame, name: str) -> DataFrame:
    """What one batch adds to a Gold table: sums and counts, not rounded, that merge with others."""
    return silver.groupBy(*_KEYS[name], "batch_id").agg(
        F.sum("sales").alias("sales"),
        F.sum("profit").alias("profit"),
        F.sum("quantity").alias("quantity"),
        F.count("sales").alias("sales_lines"),
        F.count("order_id").alias("lines"),
    )


def merge_gold_parts(parts: DataFrame, name: str) -> DataFrame:
    """The Gold table of all batches from their parts."""
    columns = {
        "total_sales": F.round(F.sum("sales"), 2),
        "total_profit": F.round(F.sum("profit"), 2),
        "total_quantity": F.sum("quantity"),
        "avg_order_value": F.round(F.try_divide(F.sum("sales"), F.sum("sales_lines")), 2),
        "order_count": F.sum("lines"),
    }
    wanted = {
        "sales_by_category_region": ("total_sales", "total_profit", "total_quantity", "order_count"),
        "sales_by_segment": ("total_sales", "total_profit", "avg_order_value", "order_count"),
        "top_products": ("total_sales", "total_profit", "total_quantity"),
    }
    return parts.groupBy(*_KEYS[name]).agg(*(columns[c].alias(c) for c in wanted[name]))
