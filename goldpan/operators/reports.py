"""Reports over the three layers.

Each takes the table it reads and returns its rows in report order. A limit comes with an order
that leaves no ties. The names of result columns are fixed values. Sorted listings of whole tables also sort by the natural key, so that range
partitioning can split a measure value that very many rows share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldpan.functions.measures import (
    distinct_orders,
    margin_pct,
    money_average,
    money_total,
    row_count,
    total_profit,
    total_quantity,
    total_sales,
)

# --- any table ---------------------------------------------------------------------------------


def total_records(table: DataFrame) -> DataFrame:
    return table.agg(row_count("total_records"))


def sample(table: DataFrame, order: list[Column], rows: int = 10) -> DataFrame:
    """The first rows in a given order; a top-k, so no full sort."""
    return table.orderBy(*order).limit(rows)


def records_by_batch(table: DataFrame) -> DataFrame:
    return table.groupBy("batch_id").agg(row_count()).orderBy("batch_id")


# --- Bronze ------------------------------------------------------------------------------------


def by_ingestion_date(bronze: DataFrame) -> DataFrame:
    """Rows and batches per day. Distinct batches of a day are few and counted on the mappers."""
    return (
        bronze.groupBy("ingestion_date")
        .agg(row_count(), F.count_distinct("batch_id").alias("batch_count"))
        .orderBy(F.desc("ingestion_date"))
    )


def source_lineage(bronze: DataFrame) -> DataFrame:
    return (
        bronze.groupBy("source_file", "source_system", "batch_id")
        .agg(
            F.min("ingestion_ts").alias("first_ingestion"),
            F.max("ingestion_ts").alias("last_ingestion"),
            row_count(),
        )
        .orderBy(F.desc("first_ingestion"), "source_file")
    )


def duplicate_keys(bronze: DataFrame, rows: int = 10) -> DataFrame:
    """The natural keys landed most often. A missing product counts as a key value."""
    return (
        bronze.groupBy("Order ID", "Product ID")
        .agg(row_count("occurrence_count"))
        .where(F.col("occurrence_count") > 1)
        .orderBy(
            F.desc("occurrence_count"),
            F.asc("Order ID"),
            F.col("Product ID").asc_nulls_first(),
        )
        .limit(rows)
    )


def partition_counts(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy("ingestion_date").agg(row_count()).orderBy(F.desc("ingestion_date"))


def bronze_by_category(bronze: DataFrame) -> DataFrame:
    totals = bronze.groupBy("Category").agg(total_sales("Sales"), row_count())
    return totals.orderBy(F.desc("total_sales"), "Category")


def bronze_by_region(bronze: DataFrame) -> DataFrame:
    totals = bronze.groupBy("Region").agg(total_sales("Sales"), total_profit("Profit"), row_count())
    return totals.orderBy(F.desc("total_sales"), "Region")


# --- Silver ------------------------------------------------------------------------------------


def _ranked_by_sales(silver: DataFrame, keys: list[str], *measures: Column) -> DataFrame:
    return silver.groupBy(*keys).agg(*measures).orderBy(F.desc("total_sales"), *keys)


def silver_by_category(silver: DataFrame) -> DataFrame:
    return _ranked_by_sales(
        silver, ["category"], total_sales(), total_profit(), total_quantity(), distinct_orders()
    )


def silver_by_region(silver: DataFrame) -> DataFrame:
    return _ranked_by_sales(
        silver, ["region"], total_sales(), total_profit(), total_quantity(), distinct_orders()
    )


def silver_by_segment(silver: DataFrame) -> DataFrame:
    average = money_average("sales", "avg_order_value")
    return _ranked_by_sales(
        silver, ["segment"], total_sales(), total_profit(), distinct_orders(), average
    )


def silver_by_batch(silver: DataFrame) -> DataFrame:
    return silver.groupBy("batch_id").agg(row_count(), total_sales()).orderBy("batch_id")


def monthly_trend(silver: DataFrame) -> DataFrame:
    return (
        silver.groupBy(F.year("order_date").alias("year"), F.month("order_date").alias("month"))
        .agg(total_sales(), total_profit(), distinct_orders())
        .orderBy("year", "month")
    )


def top_products(silver: DataFrame, rows: int = 20) -> DataFrame:
    keys = ["category", "sub_category", "product_name"]
    return _ranked_by_sales(silver, keys, total_sales(), total_profit(), total_quantity()).limit(rows)


def top_product_names(silver: DataFrame, rows: int = 5) -> DataFrame:
    keys = ["category", "product_name"]
    return _ranked_by_sales(silver, keys, total_sales(), total_quantity()).limit(rows)


def top_customers(silver: DataFrame, rows: int = 20) -> DataFrame:
    keys = ["customer_id", "customer_name", "segment", "region"]
    return _ranked_by_sales(silver, keys, distinct_orders(), total_sales(), total_profit()).limit(rows)


def high_value_orders(silver: DataFrame, above: float = 1000) -> DataFrame:
    """Every line above a sales value, largest first."""
    return (
        silver.where(F.col("sales") > above)
        .orderBy(F.desc("sales"), "order_id", "product_id")
        .select(
            "order_id", "order_date", "customer_name", "category", "product_name", "sales", "profit"
        )
    )


def unprofitable_lines(silver: DataFrame, rows: int = 20) -> DataFrame:
    return (
        silver.where(F.col("profit") < 0)
        .orderBy("profit", "order_id", "product_id")
        .limit(rows)
        .select(
            "order_id", "order_date", "category", "product_name", "sales", "profit", "discount"
        )
    )


def large_discounts(silver: DataFrame, above: float = 0.5, rows: int = 20) -> DataFrame:
    return (
        silver.where(F.col("discount") > above)
        .orderBy(F.desc("discount"), "order_id", "product_id")
        .limit(rows)
        .select(
            "order_id", "order_date", "category", "product_name", "sales", "discount", "quantity"
        )
    )


# --- Gold: sales by category and region --------------------------------------------------------


def gold_summary(gold: DataFrame) -> DataFrame:
    return gold.orderBy(F.desc("total_sales"), "category", "region")


def _rolled_up(gold: DataFrame, key: str, prefix: str, *more: Column) -> DataFrame:
    return gold.groupBy(key).agg(
        money_total("total_sales", f"{prefix}_sales"),
        money_total("total_profit", f"{prefix}_profit"),
        F.sum("order_count").alias(f"{prefix}_orders"),
        *more,
    )


def gold_by_category(gold: DataFrame) -> DataFrame:
    quantity = F.sum("total_quantity").alias("global_quantity")
    return _rolled_up(gold, "category", "global", quantity).orderBy(F.desc("global_sales"), "category")


def gold_by_region(gold: DataFrame) -> DataFrame:
    return (
        _rolled_up(gold, "region", "regional")
        .withColumn("profit_margin_pct", margin_pct("regional_profit", "regional_sales"))
        .orderBy(F.desc("regional_sales"), "region")
    )


def margin_by_region(gold: DataFrame) -> DataFrame:
    totals = gold.groupBy("region").agg(
        money_total("total_sales", "sales"), money_total("total_profit", "profit")
    )
    return totals.withColumn("margin_pct", margin_pct("profit", "sales")).orderBy(
        F.desc("profit"), "region"
    )


def gold_totals(gold: DataFrame) -> DataFrame:
    return gold.agg(
        money_total("total_sales", "global_sales"),
        money_total("total_profit", "global_profit"),
        F.sum("total_quantity").alias("global_quantity"),
        F.sum("order_count").alias("global_orders"),
        row_count("category_region_combinations"),
    )


def gold_averages(gold: DataFrame) -> DataFrame:
    return gold.agg(
        money_average("total_sales", "avg_sales"),
        money_average("total_profit", "avg_profit"),
        money_average("total_quantity", "avg_quantity"),
        money_average("order_count", "avg_orders"),
        F.round(F.min("total_sales"), 2).alias("min_sales"),
        F.round(F.max("total_sales"), 2).alias("max_sales"),
    )


def _with_margin(gold: DataFrame) -> DataFrame:
    return gold.withColumn("profit_margin_pct", margin_pct("total_profit", "total_sales"))


def best_combinations(gold: DataFrame) -> DataFrame:
    return gold_summary(_with_margin(gold))


def most_profitable(gold: DataFrame) -> DataFrame:
    profitable = _with_margin(gold.where(F.col("total_profit") > 0))
    return profitable.orderBy(F.desc("profit_margin_pct"), "category", "region")


def highest_volume(gold: DataFrame) -> DataFrame:
    return gold.orderBy(F.desc("total_quantity"), "category", "region")


def top_category_region(gold: DataFrame, rows: int = 5) -> DataFrame:
    return (
        gold_summary(gold)
        .limit(rows)
        .select("category", "region", "total_sales", "total_profit", "order_count")
    )


def rank_in_region(gold: DataFrame) -> DataFrame:
    """Categories ranked by sales within each region. Gold is small: one row per combination."""
    by_sales = Window.partitionBy("region").orderBy(F.desc("total_sales"))
    return (
        _with_margin(gold)
        .select(
            "region",
            "category",
            "total_sales",
            "total_profit",
            "profit_margin_pct",
            F.rank().over(by_sales).alias("sales_rank_in_region"),
        )
        .orderBy("region", "sales_rank_in_region", "category")
    )


def category_vs_average(gold: DataFrame) -> DataFrame:
    """Each region against the average of its category. Both windows share one shuffle."""
    category = Window.partitionBy("category")
    difference = F.col("total_sales") - F.avg("total_sales").over(category)
    rank = F.rank().over(category.orderBy(F.desc("total_sales")))
    return gold.select(
        "category",
        "region",
        "total_sales",
        "total_profit",
        F.round(difference, 2).alias("sales_vs_avg"),
        rank.alias("sales_rank_in_category"),
    ).orderBy("category", "sales_rank_in_category", "region")


def executive_kpis(gold: DataFrame) -> DataFrame:
    """One row of totals with the best category and region.

    Grouping sets give the totals, the categories and the regions in one pass over Gold.
    """
    sums = gold.groupingSets([["category"], ["region"], []], "category", "region").agg(
        F.grouping_id().alias("level"),
        F.sum("total_sales").alias("sales"),
        F.sum("total_profit").alias("profit"),
        F.sum("total_quantity").alias("quantity"),
        F.sum("order_count").alias("orders"),
    )
    # Bits of the grouping id: 1 = region rolled up, 2 = category rolled up.
    per_category, per_region, overall = (F.col("level") == level for level in (1, 2, 3))

    def total(name: str) -> Column:
        return F.max(F.when(overall, F.col(name)))

    def best(name: str, rows: Column) -> Column:
        return F.max_by(name, F.when(rows, F.struct("sales", name)))

    return sums.agg(
        F.round(total("sales"), 2).alias("global_sales"),
        F.round(total("profit"), 2).alias("global_profit"),
        margin_pct(total("profit"), total("sales"), "global_profit_margin_pct"),
        total("quantity").alias("global_quantity"),
        total("orders").alias("global_orders"),
        best("category", per_category).alias("top_category"),
        best("region", per_region).alias("top_region"),
    )


# --- Gold: segments and products ---------------------------------------------------------------


def segment_performance(segments: DataFrame) -> DataFrame:
    return segments.orderBy(F.desc("total_sales"), "segment")


def top_gold_products(products: DataFrame, rows: int) -> DataFrame:
    keys = ["category", "sub_category", "product_name"]
    return products.orderBy(F.desc("total_sales"), *keys).limit(rows)


# --- one row of stored Gold --------------------------------------------------------------------


def gold_point(gold: DataFrame, category: str, region: str) -> DataFrame:
    """One combination; both conditions reach the scan of a stored table."""
    return gold.where((F.col("category") == category) & (F.col("region") == region))
