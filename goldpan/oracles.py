"""The same queries as SQL over the supplied tables, for comparison by another engine.

The sales view is spelled out here as plain inner joins, deduplication as a window over all rows,
independently of how the Spark side prunes joins or reads layers.
"""

from __future__ import annotations

from goldpan.schema import BUSINESS_COLUMNS, LINEAGE_COLUMNS, RAW_COLUMNS, SILVER_COLUMNS

_BRONZE = """
landed AS (
    SELECT l.*, (l_orderkey * 7 + l_linenumber) % 101 AS h,
           CAST(l_orderkey % 3 + 1 AS INTEGER) AS home_batch
    FROM lineitem l
),
batched AS (
    SELECT *, home_batch AS batch_no FROM landed
    UNION ALL
    SELECT *, home_batch % 3 + 1 AS batch_no FROM landed WHERE h = 4
),
bronze AS (
    SELECT CAST(l_orderkey AS VARCHAR) AS "Order ID",
           o_orderdate AS "Order Date",
           l_shipdate AS "Ship Date",
           ' ' || o_orderpriority || ' ' AS "Ship Mode",
           CAST(c_custkey AS VARCHAR) AS "Customer ID",
           c_name AS "Customer Name",
           c_mktsegment AS "Segment",
           n_name AS "Country",
           n_name || '-' || CAST(c_custkey % 10 AS VARCHAR) AS "City",
           n_name AS "State",
           lpad(CAST(c_custkey AS VARCHAR), 5, '0') AS "Postal Code",
           r_name AS "Region",
           CASE WHEN h <> 1 THEN CAST(l_partkey AS VARCHAR) END AS "Product ID",
           p_type AS "Category",
           p_brand AS "Sub-Category",
           p_name AS "Product Name",
           CASE WHEN h <> 0 THEN l_extendedprice END AS "Sales",
           CASE WHEN h = 3 THEN 0 ELSE CAST(l_quantity AS INTEGER) END AS "Quantity",
           CASE WHEN h = 2 THEN 1.5::DOUBLE ELSE l_discount END AS "Discount",
           l_extendedprice - l_quantity * p_retailprice AS "Profit",
           CAST(DATE '2023-12-31' + batch_no AS DATE) AS ingestion_date,
           TIMESTAMP '2023-12-31 08:00:00' + batch_no * INTERVAL 1 DAY AS ingestion_ts,
           'sales_batch_00' || CAST(batch_no AS VARCHAR) || '.csv' AS source_file,
           'sales_system' AS source_system,
           'batch_' || CAST(batch_no AS VARCHAR) AS batch_id,
           batch_no
    FROM batched
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    JOIN part ON l_partkey = p_partkey
)"""


def _silver_select(trim: bool, lineage: tuple[str, ...]) -> str:
    columns = [
        (f'trim("{c.raw}")' if trim and c.trimmed else f'"{c.raw}"') + f" AS {c.name}"
        for c in BUSINESS_COLUMNS
    ]
    return ",\n           ".join([*columns, *lineage])


def _cleaned(name: str, key: str, trim: bool, lineage: tuple[str, ...]) -> str:
    return f"""
{name} AS (
    SELECT {_silver_select(trim, lineage)}
    FROM bronze
    WHERE "Order ID" IS NOT NULL AND "Product ID" IS NOT NULL AND "Sales" IS NOT NULL
    QUALIFY row_number() OVER (
        PARTITION BY {key}
        ORDER BY batch_no, "Sales", "Quantity", "Discount", "Profit", "Ship Date") = 1
)"""


_KEY = '"Order ID", "Product ID"'
_SILVER = _cleaned("silver", _KEY, True, LINEAGE_COLUMNS)
_SILVER_BY_BATCH = _cleaned(
    "silver_inc", "batch_no, " + _KEY, False, ("ingestion_date", "ingestion_ts", "batch_id")
)


def _gold_select(silver: str) -> str:
    return f"""
    SELECT category, region, round(sum(sales), 2) AS total_sales, round(sum(profit), 2) AS total_profit,
           CAST(sum(quantity) AS BIGINT) AS total_quantity, count(order_id) AS order_count
    FROM {silver} GROUP BY category, region"""


_GOLD = f"""
gold AS ({_gold_select("silver")}
),
gold_segment AS (
    SELECT segment, round(sum(sales), 2) AS total_sales, round(sum(profit), 2) AS total_profit,
           round(avg(sales), 2) AS avg_order_value, count(order_id) AS order_count
    FROM silver GROUP BY segment
),
gold_products AS (
    SELECT category, sub_category, product_name, round(sum(sales), 2) AS total_sales,
           round(sum(profit), 2) AS total_profit, CAST(sum(quantity) AS BIGINT) AS total_quantity
    FROM silver GROUP BY category, sub_category, product_name
)"""

def _with(*parts: str, query: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + query.strip()


def _bronze(query: str) -> str:
    return _with(_BRONZE, query=query)


def _silver(query: str) -> str:
    return _with(_BRONZE, _SILVER, query=query)


def _gold(query: str) -> str:
    return _with(_BRONZE, _SILVER, _GOLD, query=query)


def _incremental(query: str) -> str:
    return _with(_BRONZE, _SILVER_BY_BATCH, query=query)


_ALL_RAW = ", ".join(f'"{c}"' for c in RAW_COLUMNS)
_ALL_LINEAGE = ", ".join(LINEAGE_COLUMNS)
_ALL_SILVER = ", ".join(SILVER_COLUMNS)

_SCAN_AND_SINK = {
    "scan_csv_batch": _bronze(f"SELECT {_ALL_RAW} FROM bronze"),
    "scan_batch_inventory": _bronze(
        "SELECT source_file AS source, count(*) AS record_count FROM bronze GROUP BY source_file"
    ),
    "scan_table": _bronze(f"SELECT {_ALL_RAW}, {_ALL_LINEAGE} FROM bronze"),
    "scan_sample": _bronze(
        f"""SELECT {_ALL_RAW}, {_ALL_LINEAGE} FROM bronze
        ORDER BY "Order ID", "Product ID" NULLS LAST, batch_id, "Sales" NULLS LAST, "Quantity",
                 "Discount", "Profit", "Ship Date"
        LIMIT 10"""
    ),
    "silver_sample": _silver(
        f"SELECT {_ALL_SILVER} FROM silver ORDER BY order_id, product_id LIMIT 10"
    ),
    "file_inventory": " UNION ALL ".join(
        f"SELECT '{name}.parquet' AS file_name, 'PARQUET' AS file_format, count(*) AS record_count, "
        f"true AS has_bytes FROM {name}"
        for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
    ),
    "partition_inventory": _bronze(
        """SELECT ingestion_date, count(*) AS record_count, true AS has_files
        FROM bronze GROUP BY ingestion_date"""
    ),
    "files_by_partition": _bronze(
        """SELECT ingestion_date, count(*) AS total_records, true AS has_files, true AS has_bytes
        FROM bronze GROUP BY ingestion_date"""
    ),
    "landing_inventory": _bronze(
        "SELECT source_file AS batch_file, true AS has_bytes FROM bronze GROUP BY source_file"
    ),
    "sink_create_partitioned": _bronze(f"SELECT {_ALL_RAW}, {_ALL_LINEAGE} FROM bronze"),
    "sink_append": _bronze(
        "SELECT batch_id, count(*) AS record_count FROM bronze GROUP BY batch_id"
    ),
    "sink_create_or_replace": _gold("SELECT * FROM gold"),
    "sink_create": _gold("SELECT * FROM gold_products"),
    "sink_csv_batch": _bronze(f"SELECT {_ALL_RAW} FROM bronze"),
}

_PROJECTIONS_AND_FILTERS = {
    "enrich_lineage": _bronze(f"SELECT {_ALL_RAW}, {_ALL_LINEAGE} FROM bronze"),
    "standardize": _bronze(f"SELECT {_silver_select(True, LINEAGE_COLUMNS)} FROM bronze"),
    "standardize_min": _bronze(
        f"SELECT {_silver_select(False, ('ingestion_date', 'ingestion_ts', 'batch_id'))} FROM bronze"
    ),
    "preview": _silver(
        """SELECT order_id, product_id, category, sales, quantity FROM silver
        ORDER BY order_id, product_id LIMIT 5"""
    ),
    "drop_null_critical": _bronze(
        """SELECT "Order ID" AS order_id, "Product ID" AS product_id, "Sales" AS sales,
                  "Quantity" AS quantity, batch_id
        FROM bronze
        WHERE NOT ("Order ID" IS NULL OR "Product ID" IS NULL OR "Sales" IS NULL)"""
    ),
    "high_value_orders": _silver(
        """SELECT order_id, order_date, customer_name, category, product_name, sales, profit
        FROM silver WHERE sales > 1000"""
    ),
    "unprofitable_lines": _silver(
        """SELECT order_id, order_date, category, product_name, sales, profit, discount
        FROM silver WHERE profit < 0 ORDER BY profit, order_id, product_id LIMIT 20"""
    ),
    "large_discounts": _silver(
        """SELECT order_id, order_date, category, product_name, sales, discount, quantity
        FROM silver WHERE discount > 0.5 ORDER BY discount DESC, order_id, product_id LIMIT 20"""
    ),
}

_BRONZE_REPORTS = {
    "total_records": _bronze("SELECT count(*) AS total_records FROM bronze"),
    "by_ingestion_date": _bronze(
        """SELECT ingestion_date, count(*) AS record_count, count(DISTINCT batch_id) AS batch_count
        FROM bronze GROUP BY ingestion_date"""
    ),
    "source_lineage": _bronze(
        """SELECT source_file, source_system, batch_id, min(ingestion_ts) AS first_ingestion,
                  max(ingestion_ts) AS last_ingestion, count(*) AS record_count
        FROM bronze GROUP BY source_file, source_system, batch_id"""
    ),
    "duplicate_keys": _bronze(
        """SELECT "Order ID", "Product ID", count(*) AS occurrence_count
        FROM bronze GROUP BY "Order ID", "Product ID" HAVING count(*) > 1
        ORDER BY occurrence_count DESC, "Order ID", "Product ID" NULLS FIRST LIMIT 10"""
    ),
    "partition_counts": _bronze(
        "SELECT ingestion_date, count(*) AS record_count FROM bronze GROUP BY ingestion_date"
    ),
    "bronze_by_category": _bronze(
        """SELECT "Category", round(sum("Sales"), 2) AS total_sales, count(*) AS record_count
        FROM bronze GROUP BY "Category" """
    ),
    "bronze_by_region": _bronze(
        """SELECT "Region", round(sum("Sales"), 2) AS total_sales,
                  round(sum("Profit"), 2) AS total_profit, count(*) AS record_count
        FROM bronze GROUP BY "Region" """
    ),
    "by_batch": _bronze("SELECT batch_id, count(*) AS record_count FROM bronze GROUP BY batch_id"),
}


def _silver_totals(key: str) -> str:
    return _silver(
        f"""SELECT {key}, round(sum(sales), 2) AS total_sales, round(sum(profit), 2) AS total_profit,
                   CAST(sum(quantity) AS BIGINT) AS total_quantity,
                   count(DISTINCT order_id) AS order_count
        FROM silver GROUP BY {key}"""
    )


_SILVER_REPORTS = {
    "dedup_natural_key": _silver(
        """SELECT order_id, product_id, sales, quantity, discount, ship_date, batch_id
        FROM silver"""
    ),
    "silver_full_refresh": _silver(f"SELECT {_ALL_SILVER} FROM silver"),
    "silver_incremental": _incremental("SELECT * FROM silver_inc"),
    "silver_total_records": _silver("SELECT count(*) AS total_records FROM silver"),
    "silver_by_category": _silver_totals("category"),
    "silver_by_region": _silver_totals("region"),
    "silver_by_segment": _silver(
        """SELECT segment, round(sum(sales), 2) AS total_sales, round(sum(profit), 2) AS total_profit,
                  count(DISTINCT order_id) AS order_count, round(avg(sales), 2) AS avg_order_value
        FROM silver GROUP BY segment"""
    ),
    "silver_by_batch": _silver(
        """SELECT batch_id, count(*) AS record_count, round(sum(sales), 2) AS total_sales
        FROM silver GROUP BY batch_id"""
    ),
    "monthly_trend": _silver(
        """SELECT CAST(year(order_date) AS INTEGER) AS "year", CAST(month(order_date) AS INTEGER) AS "month",
                  round(sum(sales), 2) AS total_sales, round(sum(profit), 2) AS total_profit,
                  count(DISTINCT order_id) AS order_count
        FROM silver GROUP BY 1, 2"""
    ),
    "top_products_20": _gold(
        """SELECT * FROM gold_products
        ORDER BY total_sales DESC, category, sub_category, product_name LIMIT 20"""
    ),
    "top_products_5": _silver(
        """SELECT category, product_name, round(sum(sales), 2) AS total_sales,
                  CAST(sum(quantity) AS BIGINT) AS total_quantity
        FROM silver GROUP BY category, product_name
        ORDER BY total_sales DESC, category, product_name LIMIT 5"""
    ),
    "top_customers_20": _silver(
        """SELECT customer_id, customer_name, segment, region, count(DISTINCT order_id) AS order_count,
                  round(sum(sales), 2) AS total_sales, round(sum(profit), 2) AS total_profit
        FROM silver GROUP BY customer_id, customer_name, segment, region
        ORDER BY total_sales DESC, customer_id, customer_name, segment, region LIMIT 20"""
    ),
}


def _null_counts(table: str, order_id: str, product_id: str, sales: str) -> str:
    return (
        f"SELECT count(*) FILTER ({order_id} IS NULL) AS null_order_id, "
        f"count(*) FILTER ({product_id} IS NULL) AS null_product_id, "
        f"count(*) FILTER ({sales} IS NULL) AS null_sales, count(*) AS total_records FROM {table}"
    )


_INVALID = """count(*) FILTER (sales < 0) AS negative_sales,
              count(*) FILTER (quantity <= 0) AS invalid_quantity,
              count(*) FILTER (discount < 0 OR discount > 1) AS invalid_discount"""
_BRONZE_NULLS = _null_counts("bronze", '"Order ID"', '"Product ID"', '"Sales"')
_SILVER_NULLS = _null_counts("silver", "order_id", "product_id", "sales")
_QUALITY_CHECKS = f"""
SELECT count(*) - count(order_id) AS null_order_id, count(*) - count(product_id) AS null_product_id,
       count(*) - count(sales) AS null_sales, {_INVALID}, count(*) AS total_records
FROM silver"""

_QUALITY = {
    "quality_checks": _silver(_QUALITY_CHECKS),
    "bronze_null_counts": _bronze(_BRONZE_NULLS),
    "silver_null_counts": _silver(_SILVER_NULLS),
    "silver_invalid_counts": _silver(f"SELECT {_INVALID} FROM silver"),
    "null_counts_via_count": _silver(
        f"""SELECT * EXCLUDE (total_records), 'bronze' AS layer FROM ({_BRONZE_NULLS})
        UNION ALL
        SELECT * EXCLUDE (total_records), 'silver' AS layer FROM ({_SILVER_NULLS})"""
    ),
    "filter_rate": _silver(
        """SELECT b AS bronze_records, s AS silver_records, b - s AS filtered_records,
                  round((b - s) * 100.0::DOUBLE / nullif(b, 0), 2) AS filtered_pct
        FROM (SELECT (SELECT count(*) FROM bronze) AS b, (SELECT count(*) FROM silver) AS s)"""
    ),
    "batch_quality_summary": _bronze(
        """SELECT batch_id, count(*) AS records, count(*) - count("Sales") AS null_sales,
                  count(*) - count("Product ID") AS null_product_id,
                  count(*) FILTER ("Discount" < 0 OR "Discount" > 1) AS invalid_discount,
                  count(*) FILTER ("Quantity" <= 0) AS invalid_quantity
        FROM bronze GROUP BY batch_id"""
    ),
    "layer_counts": _gold(
        """SELECT 'bronze.sales' AS table_name, count(*) AS record_count FROM bronze
        UNION ALL SELECT 'silver.sales', count(*) FROM silver
        UNION ALL SELECT 'gold.sales_by_category_region', count(*) FROM gold
        UNION ALL SELECT 'gold.sales_by_segment', count(*) FROM gold_segment
        UNION ALL SELECT 'gold.top_products', count(*) FROM gold_products"""
    ),
}

_MARGIN = "round(100.0::DOUBLE * total_profit / nullif(total_sales, 0), 2) AS profit_margin_pct"

_GOLD_REPORTS = {
    "gold_category_region": _gold("SELECT * FROM gold"),
    "gold_segment": _gold("SELECT * FROM gold_segment"),
    "gold_products": _gold("SELECT * FROM gold_products"),
    "gold_products_10": _gold(
        """SELECT * FROM gold_products
        ORDER BY total_sales DESC, category, sub_category, product_name LIMIT 10"""
    ),
    "top5_gold_products": _gold(
        """SELECT category, product_name, total_sales, total_profit FROM gold_products
        ORDER BY total_sales DESC, category, sub_category, product_name LIMIT 5"""
    ),
    "segment_performance": _gold("SELECT * FROM gold_segment"),
    "gold_summary": _gold("SELECT * FROM gold"),
    "gold_by_category": _gold(
        """SELECT category, round(sum(total_sales), 2) AS global_sales,
                  round(sum(total_profit), 2) AS global_profit,
                  CAST(sum(total_quantity) AS BIGINT) AS global_quantity,
                  CAST(sum(order_count) AS BIGINT) AS global_orders
        FROM gold GROUP BY category"""
    ),
    "gold_by_region": _gold(
        """SELECT region, round(sum(total_sales), 2) AS regional_sales,
                  round(sum(total_profit), 2) AS regional_profit,
                  CAST(sum(order_count) AS BIGINT) AS regional_orders,
                  round(100.0::DOUBLE * sum(total_profit) / nullif(sum(total_sales), 0), 2) AS profit_margin_pct
        FROM gold GROUP BY region"""
    ),
    "margin_by_region": _gold(
        """SELECT region, round(sum(total_sales), 2) AS sales, round(sum(total_profit), 2) AS profit,
                  round(100.0::DOUBLE * sum(total_profit) / nullif(sum(total_sales), 0), 2) AS margin_pct
        FROM gold GROUP BY region"""
    ),
    "gold_totals": _gold(
        """SELECT round(sum(total_sales), 2) AS global_sales, round(sum(total_profit), 2) AS global_profit,
                  CAST(sum(total_quantity) AS BIGINT) AS global_quantity,
                  CAST(sum(order_count) AS BIGINT) AS global_orders,
                  count(*) AS category_region_combinations
        FROM gold"""
    ),
    "gold_averages": _gold(
        """SELECT round(avg(total_sales), 2) AS avg_sales, round(avg(total_profit), 2) AS avg_profit,
                  round(avg(total_quantity), 2) AS avg_quantity, round(avg(order_count), 2) AS avg_orders,
                  round(min(total_sales), 2) AS min_sales, round(max(total_sales), 2) AS max_sales
        FROM gold"""
    ),
    "best_combinations": _gold(f"SELECT *, {_MARGIN} FROM gold"),
    "most_profitable": _gold(f"SELECT *, {_MARGIN} FROM gold WHERE total_profit > 0"),
    "highest_volume": _gold("SELECT * FROM gold"),
    "top5_category_region": _gold(
        """SELECT category, region, total_sales, total_profit, order_count FROM gold
        ORDER BY total_sales DESC, category, region LIMIT 5"""
    ),
    "rank_in_region": _gold(
        f"""SELECT region, category, total_sales, total_profit, {_MARGIN},
                   CAST(rank() OVER (PARTITION BY region ORDER BY total_sales DESC) AS INTEGER)
                       AS sales_rank_in_region
        FROM gold"""
    ),
    "category_vs_average": _gold(
        """SELECT category, region, total_sales, total_profit,
                  round(total_sales - avg(total_sales) OVER (PARTITION BY category), 2) AS sales_vs_avg,
                  CAST(rank() OVER (PARTITION BY category ORDER BY total_sales DESC) AS INTEGER)
                      AS sales_rank_in_category
        FROM gold"""
    ),
    "gold_point_lookup": _gold("SELECT * FROM gold WHERE category = 'ECONOMY' AND region = 'ASIA'"),
    "executive_kpis": _gold(
        """SELECT round(sum(total_sales), 2) AS global_sales, round(sum(total_profit), 2) AS global_profit,
                  round(100.0::DOUBLE * sum(total_profit) / nullif(sum(total_sales), 0), 2)
                      AS global_profit_margin_pct,
                  CAST(sum(total_quantity) AS BIGINT) AS global_quantity,
                  CAST(sum(order_count) AS BIGINT) AS global_orders,
                  (SELECT category FROM gold GROUP BY category
                   ORDER BY sum(total_sales) DESC, category DESC LIMIT 1) AS top_category,
                  (SELECT region FROM gold GROUP BY region
                   ORDER BY sum(total_sales) DESC, region DESC LIMIT 1) AS top_region
        FROM gold"""
    ),
}

_DIRTY = """
draws AS (
    SELECT *, (l_orderkey * 7919 + l_linenumber * 104729 + l_partkey * 31) % 2147483647 AS s FROM lineitem
),
kinds AS (
    SELECT *, CASE WHEN (s * 16807) % 2147483647 < 0.05::DOUBLE * 2147483647
                   THEN ((s * 48271) % 2147483647 * 5) // 2147483647 END AS kind,
           ((s * 69621) % 2147483647 * 3) // 2147483647 AS choice,
           (s * 39373) % 2147483647 < 0.01::DOUBLE * 2147483647 AS twice
    FROM draws
),
once AS (
    SELECT CAST(l_orderkey AS VARCHAR) AS "Order ID",
           CASE WHEN kind = 1 THEN NULL ELSE CAST(l_partkey AS VARCHAR) END AS "Product ID",
           CASE WHEN kind = 0 THEN NULL ELSE l_extendedprice END AS "Sales",
           CASE WHEN kind = 4 THEN CAST(-choice AS INTEGER) ELSE CAST(l_quantity AS INTEGER) END AS "Quantity",
           CASE WHEN kind = 3 THEN CASE choice WHEN 0 THEN 1.5 WHEN 1 THEN -0.1 ELSE 2.0 END
                ELSE l_discount END AS "Discount",
           CAST(l_orderkey % 3 + 1 AS INTEGER) AS batch_no, twice
    FROM kinds
),
dirty AS (
    SELECT * EXCLUDE (twice) FROM once
    UNION ALL
    SELECT * EXCLUDE (twice) FROM once WHERE twice
)"""

# Rows in the order of the file; three batches, the last one takes what does not divide.
_EXACT = """
numbered AS (
    SELECT *, row_number() OVER () - 1 AS position, (SELECT count(*) FROM lineitem) // 3 AS size FROM lineitem
),
parts AS (
    SELECT *, CAST(least(position // size, 2) + 1 AS INTEGER) AS batch_no, position % 2147483646 + 1 AS x FROM numbered
),
squares AS (SELECT *, x * x % 2147483647 AS q, count(*) OVER (PARTITION BY batch_no) AS n FROM parts),
draws AS (SELECT *, q * q % 2147483647 * x % 2147483647 AS s FROM squares),
kinds AS (
    SELECT *,
           row_number() OVER (PARTITION BY batch_no ORDER BY s * 16807 % 2147483647, position)
               <= floor(n * 0.05::DOUBLE) AS is_dirty,
           row_number() OVER (PARTITION BY batch_no ORDER BY s * 39373 % 2147483647, position)
               <= floor(n * 0.01::DOUBLE) AS twice,
           ((s * 48271) % 2147483647 * 5) // 2147483647 AS any_kind,
           ((s * 69621) % 2147483647 * 3) // 2147483647 AS choice
    FROM draws
),
exact_once AS (
    SELECT CAST(l_orderkey AS VARCHAR) AS "Order ID",
           CASE WHEN is_dirty AND any_kind = 1 THEN NULL ELSE CAST(l_partkey AS VARCHAR) END AS "Product ID",
           CASE WHEN is_dirty AND any_kind = 0 THEN NULL ELSE l_extendedprice END AS "Sales",
           CASE WHEN is_dirty AND any_kind = 4 THEN CAST(-choice AS INTEGER)
                ELSE CAST(l_quantity AS INTEGER) END AS "Quantity",
           CASE WHEN is_dirty AND any_kind = 3 THEN CASE choice WHEN 0 THEN 1.5 WHEN 1 THEN -0.1 ELSE 2.0 END
                ELSE l_discount END AS "Discount",
           batch_no, twice
    FROM kinds
),
exact_dirty AS (
    SELECT * EXCLUDE (twice) FROM exact_once
    UNION ALL
    SELECT * EXCLUDE (twice) FROM exact_once WHERE twice
)"""

_ORDERS_BY_GROUP = " UNION ALL ".join(
    f"""SELECT '{name}' AS report, {key} AS grouped_by, round(sum(sales), 2) AS total_sales,
        round(sum(profit), 2) AS total_profit, CAST(sum(quantity) AS BIGINT) AS total_quantity,
        count(DISTINCT order_id) AS order_count
    FROM silver_inc GROUP BY {key}"""
    for name, key in (
        ("by_category", "category"),
        ("by_region", "region"),
        ("by_segment", "segment"),
        ("by_month", "CAST(year(order_date) AS VARCHAR) || '-' || CAST(month(order_date) AS VARCHAR)"),
    )
)

_RUNS_AND_TEST_BATCHES = {
    "orders_by_batch": _incremental(_ORDERS_BY_GROUP),
    "silver_upsert": _silver(f"SELECT {_ALL_SILVER} FROM silver"),
    "silver_audited": _silver(f"SELECT {_ALL_SILVER} FROM silver"),
    "quality_observed": _silver(_QUALITY_CHECKS),
    "filter_rate_observed": _QUALITY["filter_rate"],
    "quarantined": _with(
        _BRONZE,
        query="""
        SELECT "Order ID" AS order_id, "Product ID" AS product_id, "Sales" AS sales, "Quantity" AS quantity,
               "Discount" AS discount, "Profit" AS profit, batch_id,
               CASE WHEN "Order ID" IS NOT NULL AND "Product ID" IS NOT NULL AND "Sales" IS NOT NULL THEN 'duplicate_key'
                    ELSE concat_ws(',', CASE WHEN "Order ID" IS NULL THEN 'null_order_id' END,
                                   CASE WHEN "Product ID" IS NULL THEN 'null_product_id' END,
                                   CASE WHEN "Sales" IS NULL THEN 'null_sales' END) END AS reason
        FROM bronze
        QUALIFY "Order ID" IS NULL OR "Product ID" IS NULL OR "Sales" IS NULL OR row_number() OVER (
            PARTITION BY "Order ID", "Product ID", "Order ID" IS NULL OR "Product ID" IS NULL OR "Sales" IS NULL
            ORDER BY batch_no, "Sales", "Quantity", "Discount", "Profit", "Ship Date") > 1""",
    ),
    "land_stream": _bronze(f"SELECT {_ALL_RAW}, source_file, source_system, batch_id FROM bronze"),
    "split_contiguous": _with(
        _EXACT,
        query="""SELECT CAST(l_orderkey AS VARCHAR) AS "Order ID", CAST(l_partkey AS VARCHAR) AS "Product ID",
                 l_extendedprice AS "Sales", position, batch_no FROM parts""",
    ),
    "inject_exact": _with(_EXACT, query="SELECT * FROM exact_dirty"),
    "generate_contiguous": _with(_EXACT, query="SELECT * FROM exact_dirty"),
    "run_bronze": _bronze("SELECT batch_id, count(*) AS record_count FROM bronze GROUP BY batch_id"),
    "run_silver": _silver(_QUALITY_CHECKS),
    "run_gold": _GOLD_REPORTS["top5_category_region"],
    "run_layers": _QUALITY["layer_counts"],
    "gold_after_batch": _incremental(_gold_select("silver_inc")),
    "inject_quality_issues": _with(_DIRTY, query="SELECT * EXCLUDE (batch_no) FROM dirty"),
    "generate_batches": _with(_DIRTY, query="SELECT * FROM dirty"),
    "split_batches": """
        SELECT CAST(l_orderkey % 3 + 1 AS INTEGER) AS batch_no, count(*) AS records,
               min(l_orderkey) AS first_order, max(l_orderkey) AS last_order
        FROM lineitem GROUP BY 1""",
}


_LOOKUP = "SELECT order_id, product_id, customer_id, order_date, sales, profit FROM silver WHERE "


def _column_statistics(numbers: tuple[str, ...], texts: tuple[str, ...], days: tuple[str, ...]) -> str:
    def of(column: str, as_number: str, as_text: str) -> str:
        number, text = as_number.format(column), as_text.format(column)
        return f"""
        SELECT '{column}' AS column_name, count(*) AS record_count, count(*) - count({column}) AS null_count,
               min({number}) AS min_number, max({number}) AS max_number, min({text}) AS min_text, max({text}) AS max_text
        FROM orders"""

    parts = [of(c, "{}::DOUBLE", "NULL::VARCHAR") for c in numbers] + [of(c, "NULL::DOUBLE", "{}") for c in texts]
    parts += [of(c, "NULL::DOUBLE", "strftime({}, '%Y-%m-%d %H:%M:%S')") for c in days]
    return " UNION ALL ".join(parts)


_LAYOUT = {
    "lookup_order": _silver(_LOOKUP + "order_id IN ('7', '1024')"),
    "lookup_customer": _silver(_LOOKUP + "customer_id = '11'"),
    "lookup_box": _silver(_LOOKUP + "order_date BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-03-31' AND sales >= 50000"),
    "file_statistics": _column_statistics(
        ("o_orderkey", "o_custkey", "o_totalprice"), ("o_orderstatus", "o_orderpriority"), ("o_orderdate",)
    ),
}


def all_oracles() -> dict[str, str]:
    return {
        **_SCAN_AND_SINK,
        **_PROJECTIONS_AND_FILTERS,
        **_BRONZE_REPORTS,
        **_SILVER_REPORTS,
        **_QUALITY,
        **_GOLD_REPORTS,
        **_RUNS_AND_TEST_BATCHES,
        **_LAYOUT,
    }
