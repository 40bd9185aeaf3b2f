"""Every operator as a named query over the supplied tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldpan.operators import exact_batches, issues, layout, quality, reports, sinks
from goldpan.operators.bronze import enrich_with_metadata
from goldpan.operators.gold import (
    create_sales_by_category_region,
    create_sales_by_segment,
    create_top_products,
)
from goldpan.operators.silver import drop_incomplete, standardize_without_trim, type_raw_columns
from goldpan.plans import audited, distinct_orders, medallion, upsert
from goldpan.schema import LINEAGE_COLUMNS, NATURAL_KEY, RAW_COLUMNS, SILVER_COLUMNS
from goldpan.sources import footers
from goldpan.sources import sales_view as view
from goldpan.sources.csv_batches import (
    FILE_GLOB,
    FOLDER_NAME,
    batch_inventory,
    read_sales_csv,
    write_batches,
    write_sales_csv,
)
from goldpan.sources.files import data_files, files_per_partition, landed_files, partitions
from goldpan.storage import fresh_path, materialize
from goldpan.streaming import landing

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register under the function's name."""
    _QUERIES[function.__name__] = function
    return function


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- frames the queries start from -------------------------------------------------------------

_KEY_AND_SALES = ("order_id", "product_id", "sales")
_GOLD_INPUT = ("order_id", "category", "region", "sales", "profit", "quantity")
_SEGMENT_INPUT = ("order_id", "segment", "sales", "profit")
_PRODUCT_INPUT = ("category", "sub_category", "product_name", "sales", "profit", "quantity")


def _gold(spark, sf_dir):
    return create_sales_by_category_region(view.silver(spark, sf_dir, *_GOLD_INPUT))


def _segments(spark, sf_dir):
    return create_sales_by_segment(view.silver(spark, sf_dir, *_SEGMENT_INPUT))


def _products(spark, sf_dir):
    return create_top_products(view.silver(spark, sf_dir, *_PRODUCT_INPUT))


def _first_rows_order(order_id: str, product_id: str, *more: str) -> list:
    return [F.col(f"`{c}`").asc_nulls_last() for c in (order_id, product_id, *more)]


def _landed_batches(spark, sf_dir, *raw_columns) -> str:
    """The supplied batches written as CSV drops; returns the landing folder."""
    folder = fresh_path(spark, "landing")
    rows = view.bronze(spark, sf_dir, *raw_columns, keep=("batch_no",)).drop(*LINEAGE_COLUMNS)
    write_batches(rows, folder)
    return folder


def _batch_paths(folder: str) -> list[str]:
    return [f"{folder}/{FOLDER_NAME.format(n)}" for n in range(1, view.BATCHES + 1)]


def _batch(spark, sf_dir, number: int) -> DataFrame:
    rows = view.bronze(spark, sf_dir, keep=("batch_no",))
    return rows.where(F.col("batch_no") == number).drop("batch_no")


# --- scans and sources -------------------------------------------------------------------------


@query
def scan_csv_batch(spark, sf_dir):
    """All batches, each with a header of its own, typed as Silver types them."""
    return type_raw_columns(read_sales_csv(spark, _batch_paths(_landed_batches(spark, sf_dir))))


@query
def scan_batch_inventory(spark, sf_dir):
    folder = _landed_batches(spark, sf_dir, "Order ID", "Product ID", "Sales")
    return batch_inventory(spark, folder)


@query
def scan_table(spark, sf_dir):
    return _stored_bronze(spark, sf_dir)


@query
def scan_sample(spark, sf_dir):
    order = ("batch_id", "Sales", "Quantity", "Discount", "Profit", "Ship Date")
    return reports.sample(view.bronze(spark, sf_dir), _first_rows_order("Order ID", "Product ID", *order))


@query
def silver_sample(spark, sf_dir):
    return reports.sample(view.silver(spark, sf_dir), _first_rows_order(*NATURAL_KEY))


@query
def file_inventory(spark, sf_dir):
    """Data files of the seven star tables, by path; a size differs by writer, so only that there is one."""
    names = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
    files = [data_files(view.table(spark, sf_dir, name)) for name in names]
    return (
        reduce(DataFrame.unionByName, files)
        .orderBy("file_path")
        .select(
            F.regexp_extract("file_path", r"([^/]+\.parquet)(?:/[^/]*)?$", 1).alias("file_name"),
            "file_format",
            "record_count",
            (F.col("file_size_in_bytes") > 0).alias("has_bytes"),
        )
    )


def _stored_bronze(spark, sf_dir, *raw_columns) -> DataFrame:
    path = fresh_path(spark, "bronze")
    sinks.create_bronze_table(view.bronze(spark, sf_dir, *raw_columns), path)
    return sinks.read_table(spark, path)


@query
def partition_inventory(spark, sf_dir):
    stored = _stored_bronze(spark, sf_dir, "Order ID", "Product ID", "Sales")
    listing = partitions(stored, ("ingestion_date",))
    return listing.select("ingestion_date", "record_count", (F.col("file_count") >= 1).alias("has_files"))


@query
def files_by_partition(spark, sf_dir):
    stored = _stored_bronze(spark, sf_dir, "Order ID", "Product ID", "Sales")
    return files_per_partition(data_files(stored, ("ingestion_date",))).select(
        "ingestion_date",
        "total_records",
        (F.col("file_count") >= 1).alias("has_files"),
        (F.col("total_size_bytes") > 0).alias("has_bytes"),
    )


@query
def landing_inventory(spark, sf_dir):
    folder = _landed_batches(spark, sf_dir, "Order ID", "Product ID", "Sales")
    batch = F.regexp_extract("path", r"(sales_batch_[0-9]+\.csv)", 1).alias("batch_file")
    return landed_files(spark, folder, FILE_GLOB).groupBy(batch).agg((F.sum("size_bytes") > 0).alias("has_bytes"))


# --- sinks -------------------------------------------------------------------------------------


@query
def sink_create_partitioned(spark, sf_dir):
    """All batches, which came on several days."""
    return _stored_bronze(spark, sf_dir)


@query
def sink_append(spark, sf_dir):
    path = fresh_path(spark, "bronze")
    for number in range(1, view.BATCHES + 1):
        sinks.append_to_bronze(_batch(spark, sf_dir, number), path)
    return reports.records_by_batch(sinks.read_table(spark, path))


@query
def sink_create_or_replace(spark, sf_dir):
    path = fresh_path(spark, "gold")
    sinks.create_table(_segments(spark, sf_dir), path)
    sinks.create_or_replace_table(_gold(spark, sf_dir), path)
    return sinks.read_table(spark, path)


@query
def sink_create(spark, sf_dir):
    path = fresh_path(spark, "gold")
    sinks.create_table(_products(spark, sf_dir), path)
    return sinks.read_table(spark, path)


@query
def sink_csv_batch(spark, sf_dir):
    path = fresh_path(spark, "sales_batch") + ".csv"
    write_sales_csv(view.bronze(spark, sf_dir).select(*RAW_COLUMNS), path, compression="gzip")
    return type_raw_columns(read_sales_csv(spark, path))


# --- projections and filters -------------------------------------------------------------------


@query
def enrich_lineage(spark, sf_dir):
    """Every batch with the lineage of its arrival."""
    batches = [
        enrich_with_metadata(
            _batch(spark, sf_dir, number).select(*RAW_COLUMNS),
            f"sales_batch_{number:03d}.csv",
            "sales_system",
            f"batch_{number}",
            F.lit(arrival).cast("timestamp"),
        )
        for number, arrival in enumerate(view.ARRIVALS, start=1)
    ]
    return reduce(DataFrame.unionByName, batches)


@query
def standardize(spark, sf_dir):
    return view.standardized(spark, sf_dir)


@query
def standardize_min(spark, sf_dir):
    return standardize_without_trim(view.bronze(spark, sf_dir))


@query
def preview(spark, sf_dir):
    rows = view.silver(spark, sf_dir, "order_id", "product_id", "category", "sales", "quantity")
    return reports.sample(rows, _first_rows_order(*NATURAL_KEY), rows=5)


@query
def drop_null_critical(spark, sf_dir):
    columns = ("order_id", "product_id", "sales", "quantity", "batch_id")
    return drop_incomplete(view.standardized(spark, sf_dir, *columns)).select(*columns)


@query
def high_value_orders(spark, sf_dir):
    columns = (
        "order_id", "product_id", "order_date", "customer_name", "category", "product_name",
        "sales", "profit",
    )
    return reports.high_value_orders(view.silver(spark, sf_dir, *columns))


@query
def unprofitable_lines(spark, sf_dir):
    columns = (
        "order_id", "product_id", "order_date", "category", "product_name", "sales", "profit",
        "discount",
    )
    return reports.unprofitable_lines(view.silver(spark, sf_dir, *columns))


@query
def large_discounts(spark, sf_dir):
    columns = (
        "order_id", "product_id", "order_date", "category", "product_name", "sales", "discount",
        "quantity",
    )
    return reports.large_discounts(view.silver(spark, sf_dir, *columns))


# --- Bronze reports ----------------------------------------------------------------------------


@query
def total_records(spark, sf_dir):
    return reports.total_records(view.bronze(spark, sf_dir, "Order ID"))


@query
def by_ingestion_date(spark, sf_dir):
    return reports.by_ingestion_date(view.bronze(spark, sf_dir, "Order ID"))


@query
def source_lineage(spark, sf_dir):
    return reports.source_lineage(view.bronze(spark, sf_dir, "Order ID"))


@query
def duplicate_keys(spark, sf_dir):
    return reports.duplicate_keys(view.bronze(spark, sf_dir, "Order ID", "Product ID"))


@query
def partition_counts(spark, sf_dir):
    return reports.partition_counts(view.bronze(spark, sf_dir, "Order ID"))


@query
def bronze_by_category(spark, sf_dir):
    return reports.bronze_by_category(view.bronze(spark, sf_dir, "Category", "Sales"))


@query
def bronze_by_region(spark, sf_dir):
    return reports.bronze_by_region(view.bronze(spark, sf_dir, "Region", "Sales", "Profit"))


@query
def by_batch(spark, sf_dir):
    return reports.records_by_batch(view.bronze(spark, sf_dir, "Order ID"))


# --- Silver and its reports --------------------------------------------------------------------


@query
def dedup_natural_key(spark, sf_dir):
    columns = ("order_id", "product_id", "sales", "quantity", "discount", "ship_date", "batch_id")
    return view.silver(spark, sf_dir, *columns)


@query
def silver_full_refresh(spark, sf_dir):
    return view.silver(spark, sf_dir)


@query
def silver_incremental(spark, sf_dir):
    return standardize_without_trim(view.cleaned(spark, sf_dir, each_batch=True))


@query
def silver_total_records(spark, sf_dir):
    return reports.total_records(view.silver(spark, sf_dir, "order_id"))


@query
def silver_by_category(spark, sf_dir):
    return reports.silver_by_category(
        view.silver(spark, sf_dir, "order_id", "category", "sales", "profit", "quantity")
    )


@query
def silver_by_region(spark, sf_dir):
    return reports.silver_by_region(
        view.silver(spark, sf_dir, "order_id", "region", "sales", "profit", "quantity")
    )


@query
def silver_by_segment(spark, sf_dir):
    return reports.silver_by_segment(view.silver(spark, sf_dir, *_SEGMENT_INPUT))


@query
def silver_by_batch(spark, sf_dir):
    return reports.silver_by_batch(view.silver(spark, sf_dir, "batch_id", "sales"))


@query
def monthly_trend(spark, sf_dir):
    return reports.monthly_trend(
        view.silver(spark, sf_dir, "order_id", "order_date", "sales", "profit")
    )


@query
def top_products_20(spark, sf_dir):
    return reports.top_products(view.silver(spark, sf_dir, *_PRODUCT_INPUT))


@query
def top_products_5(spark, sf_dir):
    return reports.top_product_names(
        view.silver(spark, sf_dir, "category", "product_name", "sales", "quantity")
    )


@query
def top_customers_20(spark, sf_dir):
    columns = ("order_id", "customer_id", "customer_name", "segment", "region", "sales", "profit")
    return reports.top_customers(view.silver(spark, sf_dir, *columns))


# --- quality counters --------------------------------------------------------------------------

_CHECKED = ("order_id", "product_id", "sales", "quantity", "discount")


@query
def quality_checks(spark, sf_dir):
    return quality.run_quality_checks(view.silver(spark, sf_dir, *_CHECKED))


@query
def bronze_null_counts(spark, sf_dir):
    return quality.bronze_null_counts(view.bronze(spark, sf_dir, "Order ID", "Product ID", "Sales"))


@query
def silver_null_counts(spark, sf_dir):
    return quality.silver_null_counts(view.silver(spark, sf_dir, *_KEY_AND_SALES))


@query
def silver_invalid_counts(spark, sf_dir):
    return quality.silver_invalid_counts(view.silver(spark, sf_dir, *_CHECKED))


@query
def null_counts_via_count(spark, sf_dir):
    bronze = view.bronze(spark, sf_dir, "Order ID", "Product ID", "Sales")
    return quality.null_counts_by_layer(bronze, view.silver(spark, sf_dir, *_KEY_AND_SALES))


@query
def filter_rate(spark, sf_dir):
    bronze = view.bronze(spark, sf_dir, "Order ID")
    return quality.filter_rate(bronze, view.silver(spark, sf_dir, "order_id"))


@query
def batch_quality_summary(spark, sf_dir):
    columns = ("Sales", "Product ID", "Discount", "Quantity")
    return quality.batch_quality_summary(view.bronze(spark, sf_dir, *columns))


@query
def layer_counts(spark, sf_dir):
    """Silver is written once, so the three Gold tables do not repeat its joins."""
    columns = {*_GOLD_INPUT, *_SEGMENT_INPUT, *_PRODUCT_INPUT}
    silver = materialize(view.silver(spark, sf_dir, *sorted(columns)), "silver")
    return quality.table_counts(
        {
            "bronze.sales": view.bronze(spark, sf_dir, "Order ID"),
            "silver.sales": silver,
            "gold.sales_by_category_region": create_sales_by_category_region(silver),
            "gold.sales_by_segment": create_sales_by_segment(silver),
            "gold.top_products": create_top_products(silver),
        }
    )


# --- Gold --------------------------------------------------------------------------------------


@query
def gold_category_region(spark, sf_dir):
    return _gold(spark, sf_dir)


@query
def gold_segment(spark, sf_dir):
    return _segments(spark, sf_dir)


@query
def gold_products(spark, sf_dir):
    return _products(spark, sf_dir)


@query
def gold_products_10(spark, sf_dir):
    return reports.top_gold_products(_products(spark, sf_dir), rows=10)


@query
def top5_gold_products(spark, sf_dir):
    top = reports.top_gold_products(_products(spark, sf_dir), rows=5)
    return top.select("category", "product_name", "total_sales", "total_profit")


@query
def segment_performance(spark, sf_dir):
    return reports.segment_performance(_segments(spark, sf_dir))


@query
def gold_summary(spark, sf_dir):
    return reports.gold_summary(_gold(spark, sf_dir))


@query
def gold_by_category(spark, sf_dir):
    return reports.gold_by_category(_gold(spark, sf_dir))


@query
def gold_by_region(spark, sf_dir):
    return reports.gold_by_region(_gold(spark, sf_dir))


@query
def margin_by_region(spark, sf_dir):
    return reports.margin_by_region(_gold(spark, sf_dir))


@query
def gold_totals(spark, sf_dir):
    return reports.gold_totals(_gold(spark, sf_dir))


@query
def gold_averages(spark, sf_dir):
    return reports.gold_averages(_gold(spark, sf_dir))


@query
def best_combinations(spark, sf_dir):
    return reports.best_combinations(_gold(spark, sf_dir))


@query
def most_profitable(spark, sf_dir):
    return reports.most_profitable(_gold(spark, sf_dir))


@query
def highest_volume(spark, sf_dir):
    return reports.highest_volume(_gold(spark, sf_dir))


@query
def top5_category_region(spark, sf_dir):
    return reports.top_category_region(_gold(spark, sf_dir))


@query
def rank_in_region(spark, sf_dir):
    return reports.rank_in_region(_gold(spark, sf_dir))


@query
def category_vs_average(spark, sf_dir):
    return reports.category_vs_average(_gold(spark, sf_dir))


@query
def executive_kpis(spark, sf_dir):
    return reports.executive_kpis(_gold(spark, sf_dir))


@query
def gold_point_lookup(spark, sf_dir):
    """One combination of a stored Gold table."""
    path = fresh_path(spark, "gold")
    sinks.create_table(_gold(spark, sf_dir), path)
    return reports.gold_point(sinks.read_table(spark, path), category="ECONOMY", region="ASIA")


def _clustered_silver(spark, sf_dir) -> DataFrame:
    """Silver written in small boxes of date and sales, with bloom filters on its keys."""
    path = fresh_path(spark, "clustered")
    silver = view.silver(spark, sf_dir, "order_id", "product_id", "customer_id", "order_date", "sales", "profit")
    layout.write_clustered(silver, path, near=["order_date", "sales"], keys=["order_id", "customer_id"])
    return sinks.read_table(spark, path)


@query
def lookup_order(spark, sf_dir):
    return layout.lookup(_clustered_silver(spark, sf_dir), "order_id", ["7", "1024"])


@query
def lookup_customer(spark, sf_dir):
    return layout.lookup(_clustered_silver(spark, sf_dir), "customer_id", ["11"])


@query
def lookup_box(spark, sf_dir):
    """High sales of a quarter."""
    quarter = tuple(F.lit(day).cast("timestamp") for day in ("1996-01-01", "1996-03-31"))
    return layout.in_box(_clustered_silver(spark, sf_dir), {"order_date": quarter, "sales": (50_000.0, None)})


@query
def file_statistics(spark, sf_dir):
    """Rows, nulls and bounds of a table by column, from the footers of its files."""
    files = footers.file_statistics(spark, f"{sf_dir}/orders.parquet")
    return footers.table_statistics(files).drop("compressed_bytes")


# --- whole runs --------------------------------------------------------------------------------


def _lake(spark) -> medallion.Medallion:
    return medallion.Medallion(spark, fresh_path(spark, "lake"))


def _landed_lake(spark, sf_dir) -> medallion.Medallion:
    """A lake whose Bronze holds all batches, landed as CSV and read back."""
    lake = _lake(spark)
    folder = _landed_batches(spark, sf_dir)
    for number in range(1, view.BATCHES + 1):
        medallion.run_bronze(lake, folder, number, FOLDER_NAME)
    return lake


@query
def run_bronze(spark, sf_dir):
    lake = _landed_lake(spark, sf_dir)
    return reports.records_by_batch(lake.read(lake.bronze))


@query
def run_silver(spark, sf_dir):
    return medallion.run_silver(_landed_lake(spark, sf_dir))


@query
def run_gold(spark, sf_dir):
    lake = _landed_lake(spark, sf_dir)
    medallion.run_silver(lake)
    return reports.top_category_region(medallion.run_gold(lake))


@query
def run_layers(spark, sf_dir):
    return medallion.run_layers(_lake(spark), _landed_batches(spark, sf_dir), naming=FOLDER_NAME)


@query
def gold_after_batch(spark, sf_dir):
    lake = _lake(spark)
    medallion.run_batch_by_batch(lake, _landed_batches(spark, sf_dir), naming=FOLDER_NAME)
    return lake.read(lake.gold["sales_by_category_region"])


@query
def silver_upsert(spark, sf_dir):
    """Silver after each batch was upserted by itself, the first batch last."""
    lake = _lake(spark)
    sinks.replace_partitions(view.bronze(spark, sf_dir), lake.bronze, sinks.BATCH_PARTITION)
    for number in (3, 2, 1):
        upsert.upsert_silver(lake, number)
    return lake.read(lake.silver).select(*SILVER_COLUMNS)


@query
def orders_by_batch(spark, sf_dir):
    """Sums and distinct orders by category, region, segment and month, added batch by batch, one of them twice."""
    lake = _lake(spark)
    sinks.replace_partitions(view.bronze(spark, sf_dir), lake.bronze, sinks.BATCH_PARTITION)
    for number in (2, 1, 3, 1):
        medallion.append_silver(lake, number)
        distinct_orders.add_batch(lake, number)
    reports_by_group = [
        distinct_orders.report(lake, name).select(
            F.lit(name).alias("report"),
            F.concat_ws("-", *keys).alias("grouped_by"),
            "total_sales",
            "total_profit",
            "total_quantity",
            "order_count",
        )
        for name, keys in distinct_orders.REPORTS.items()
    ]
    return reduce(DataFrame.unionByName, reports_by_group)


def _audited_lake(spark, sf_dir) -> tuple[medallion.Medallion, audited.Audit]:
    """A lake of all batches whose Silver was written with its quarantine."""
    lake = _lake(spark)
    rows = view.bronze(spark, sf_dir)
    sinks.create_or_replace_table(rows, lake.bronze, sinks.BATCH_PARTITION)
    return lake, audited.run_silver_audited(lake)


@query
def quality_observed(spark, sf_dir):
    """The quality counters as observed while Silver was written."""
    return _audited_lake(spark, sf_dir)[1].quality_checks()


@query
def filter_rate_observed(spark, sf_dir):
    return _audited_lake(spark, sf_dir)[1].filter_rate()


@query
def silver_audited(spark, sf_dir):
    return audited.silver_of(_audited_lake(spark, sf_dir)[0])


@query
def quarantined(spark, sf_dir):
    """The rows that Silver dropped, each with its reason."""
    rows = audited.quarantine_of(_audited_lake(spark, sf_dir)[0])
    return rows.select("order_id", "product_id", "sales", "quantity", "discount", "profit", "batch_id", "reason")


@query
def land_stream(spark, sf_dir):
    """Bronze after all batches were landed by a stream, one file at a time."""
    lake, folder = _lake(spark), _landed_batches(spark, sf_dir)
    landing.land_stream(lake, folder, fresh_path(spark, "landing-checkpoint"), files_per_batch=1)
    landed = type_raw_columns(lake.read(lake.bronze))
    return landed.select(*RAW_COLUMNS, "source_file", "source_system", "batch_id")


_CLEAN_COLUMNS = ("Order ID", "Product ID", "Sales", "Quantity", "Discount")


# --- test batches ------------------------------------------------------------------------------


def _clean_lines(spark, sf_dir) -> DataFrame:
    """Order lines without injected issues, with a spread number that SQL can also compute."""
    lines = view.table(spark, sf_dir, "lineitem")
    return lines.select(
        F.col("l_orderkey").cast("string").alias("Order ID"),
        F.col("l_partkey").cast("string").alias("Product ID"),
        F.col("l_extendedprice").alias("Sales"),
        F.col("l_quantity").cast("int").alias("Quantity"),
        F.col("l_discount").alias("Discount"),
        "l_orderkey",
        (F.col("l_orderkey") * 7919 + F.col("l_linenumber") * 104729 + F.col("l_partkey") * 31).alias("spread"),
    )


@query
def inject_quality_issues(spark, sf_dir):
    dirty = issues.introduce_quality_issues(_clean_lines(spark, sf_dir), spread=F.col("spread"))
    return dirty.drop("l_orderkey", "spread")


@query
def split_batches(spark, sf_dir):
    batches = issues.assign_batches(_clean_lines(spark, sf_dir), F.col("l_orderkey"))
    return (
        batches.groupBy("batch_no")
        .agg(
            F.count("*").alias("records"),
            F.min("l_orderkey").alias("first_order"),
            F.max("l_orderkey").alias("last_order"),
        )
        .orderBy("batch_no")
    )


@query
def generate_batches(spark, sf_dir):
    """The dirtied lines written as batches and read back, each with its batch."""
    folder = fresh_path(spark, "generated")
    lines = _clean_lines(spark, sf_dir)
    issues.generate_batches(lines, folder, F.col("l_orderkey"), spread=F.col("spread"), columns=_CLEAN_COLUMNS)
    rows = [
        read_sales_csv(spark, path).select("*", F.lit(number).alias("batch_no"))
        for number, path in enumerate(_batch_paths(folder), start=1)
    ]
    return type_raw_columns(reduce(DataFrame.unionByName, rows))


def _in_file_order(spark, sf_dir) -> DataFrame:
    return view.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("Order ID"),
        F.col("l_partkey").cast("string").alias("Product ID"),
        F.col("l_extendedprice").alias("Sales"),
        F.col("l_quantity").cast("int").alias("Quantity"),
        F.col("l_discount").alias("Discount"),
    )


@query
def split_contiguous(spark, sf_dir):
    rows, _ = exact_batches.split_contiguous(_in_file_order(spark, sf_dir))
    return rows.select("Order ID", "Product ID", "Sales", "position", "batch_no")


@query
def inject_exact(spark, sf_dir):
    dirty = exact_batches.introduce_exact_issues(*exact_batches.split_contiguous(_in_file_order(spark, sf_dir)))
    return dirty.drop("position")


@query
def generate_contiguous(spark, sf_dir):
    """Contiguous dirtied batches written as CSV and read back, each with its batch."""
    folder = fresh_path(spark, "generated")
    exact_batches.generate_contiguous_batches(_in_file_order(spark, sf_dir), folder, columns=_CLEAN_COLUMNS)
    rows = [
        read_sales_csv(spark, path).select("*", F.lit(number).alias("batch_no"))
        for number, path in enumerate(_batch_paths(folder), start=1)
    ]
    return type_raw_columns(reduce(DataFrame.unionByName, rows))
