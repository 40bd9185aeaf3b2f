"""Silver rules on small frames, against brute force, and the plans behind them."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from goldpan.operators.silver import (
    apply_quality_filters,
    keep_first_per_key,
    split_by_repeated_keys,
    standardize_sales_columns,
    standardize_without_trim,
    stored_to_silver,
    transform_batches_to_silver,
    transform_to_silver,
)
from goldpan.queries import all_queries
from goldpan.schema import RAW_COLUMNS, SILVER_COLUMNS
from goldpan.sources import sales_view as view
from tests.compare import spark_bag


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_standard_columns(spark, tiny):
    bronze = view.bronze(spark, tiny)
    silver = standardize_sales_columns(bronze)
    assert tuple(silver.columns) == SILVER_COLUMNS
    assert len(standardize_without_trim(bronze).columns) == 23
    assert silver.where(F.col("ship_mode").startswith(" ")).isEmpty()
    assert not standardize_without_trim(bronze).where(F.col("ship_mode").startswith(" ")).isEmpty()


def test_unreadable_numbers_drop_only_where_critical(spark, tiny):
    bronze = view.bronze(spark, tiny).limit(3)
    texts = bronze.withColumns({"Sales": F.lit("n/a"), "Discount": F.lit("n/a")})
    assert standardize_sales_columns(texts).where("sales is null and discount is null").count() == 3
    assert apply_quality_filters(standardize_sales_columns(texts)).isEmpty()


@pytest.mark.parametrize("seed", range(5))
def test_first_arrival_against_brute_force(spark, seed):
    draw = random.Random(seed)
    rows = []
    for _ in range(400):
        hot = draw.random() < 0.4
        key = ("hot", "hot") if hot else (str(draw.randrange(30)), str(draw.randrange(4)))
        rows.append((*key, draw.randrange(1, 4), draw.choice([1.0, 2.0, 3.0]), draw.randrange(4)))
    df = spark.createDataFrame(
        rows, "order_id string, product_id string, batch int, sales double, quantity int"
    )
    kept = keep_first_per_key(df, arrival_order=("batch", "sales")).collect()
    best = {}
    for r in rows:
        best[r[:2]] = min(best.get(r[:2], r[2:]), r[2:])
    assert {(r.order_id, r.product_id): (r.batch, r.sales, r.quantity) for r in kept} == best
    assert len(kept) == len(best)


def test_the_same_row_stays_in_any_row_order(spark):
    rows = [("o", "p", 1.0, name, city) for name in "ABCDEFGH" for city in ("x", None)]
    kept = set()
    for seed in range(6):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "order_id string, product_id string, sales double, customer_name string, city string")
        kept.update(map(tuple, keep_first_per_key(df.repartition(1 + seed)).collect()))
    assert kept == {("o", "p", 1.0, "A", None)}


def test_hot_key_is_reduced_before_the_shuffle(spark, tiny):
    """A key with a third of all rows must not reach one task whole."""
    plan = plan_of(transform_to_silver(view.bronze(spark, tiny)))
    shuffle = plan.index("Exchange hashpartitioning(order_id")
    partial = [i for i, line in enumerate(plan.splitlines()) if "WindowGroupLimit" in line and "Partial" in line]
    assert partial and plan.splitlines()[partial[0]] in plan[shuffle:]


def test_full_and_incremental_refresh(spark, tiny):
    bronze = view.bronze(spark, tiny)
    full, incremental = transform_to_silver(bronze), transform_batches_to_silver(bronze)
    keys = full.groupBy("order_id", "product_id").count().where("count > 1")
    assert keys.isEmpty()
    assert incremental.groupBy("batch_id", "order_id", "product_id").count().where("count > 1").isEmpty()
    assert full.count() <= incremental.count() <= bronze.count()
    counts = Counter(r.batch_id for r in incremental.select("batch_id").collect())
    assert counts == {"batch_1": 1878, "batch_2": 2018, "batch_3": 1979}


def test_pruned_view_equals_the_full_one(spark, tiny):
    """Leaving out dimensions nobody asked for changes no row."""
    columns = ("order_id", "product_id", "sales", "quantity", "batch_id")
    columns_of = {c: view.silver(spark, tiny, "order_id", "product_id", c) for c in ("discount", "profit")}
    assert columns_of["discount"].count() == columns_of["profit"].count()
    pruned = view.silver(spark, tiny, *columns)
    full = transform_to_silver(view.bronze(spark, tiny)).select(*columns)
    assert pruned.exceptAll(full).isEmpty() and full.exceptAll(pruned).isEmpty()
    assert "Join" not in plan_of(pruned)


def test_scans_read_only_what_a_query_needs(spark, tiny):
    plan = plan_of(all_queries()["bronze_by_category"](spark, tiny))
    assert "ReadSchema: struct<p_partkey:bigint,p_type:string>" in plan
    assert "orders.parquet" not in plan and "customer.parquet" not in plan


def test_no_nested_loops_and_no_forced_broadcast(spark, tiny):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("silver_full_refresh", "gold_category_region", "top_customers_20"):
            plan = plan_of(all_queries()[name](spark, tiny))
            assert "NestedLoop" not in plan and "Cartesian" not in plan and "Broadcast" not in plan, name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_limited_reports_are_top_k(spark, tiny):
    for name in ("top_products_20", "unprofitable_lines", "duplicate_keys", "scan_sample"):
        assert "TakeOrderedAndProject" in plan_of(all_queries()[name](spark, tiny)), name


def test_no_python_workers(spark, tiny):
    for name in ("silver_full_refresh", "executive_kpis", "inject_quality_issues"):
        plan = plan_of(all_queries()[name](spark, tiny))
        assert "Python" not in plan and "Pandas" not in plan, name


def test_lines_are_shuffled_twice_at_most(spark, tiny):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(view.silver(spark, tiny))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    moves = [line for line in plan.splitlines() if "Exchange hashpartitioning(l_" in line]
    assert 1 <= len(moves) <= 2, moves


def test_null_filter_reaches_stored_bronze(spark, tiny, tmp_path):
    path = str(tmp_path / "bronze")
    view.bronze(spark, tiny).write.parquet(path)
    plan = plan_of(transform_to_silver(spark.read.parquet(path)))
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    assert all(c in pushed.split("PushedFilters")[1] for c in ("IsNotNull(`Order ID`)", "IsNotNull(`Product ID`)")), pushed


def test_stored_gold_is_looked_up_by_pushed_filters(spark, tiny):
    plan = plan_of(all_queries()["gold_point_lookup"](spark, tiny))
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    assert "EqualTo(category,ECONOMY)" in pushed and "EqualTo(region,ASIA)" in pushed


def test_only_rows_of_repeated_keys_are_ranked(spark, tmp_path):
    path = str(tmp_path / "bronze")
    columns = ["Order ID", "Product ID", "Sales", "batch_id", "City"]
    rows = [(f"o{i}", "p", "1.0", "batch_1", " c ") for i in range(50)]
    rows += [("o1", "p", "0.5", "batch_1", "first"), ("o1", "p", "2", "batch_1", "later"), ("o2", "p", "x", "batch_1", "unread")]
    rows += [(None, "p", "1", "batch_1", "a"), ("o3", None, "1", "batch_1", "b"), ("o4", "p", None, "batch_1", "c")]
    rows += [("o5", "p", "0.1", None, "no batch"), ("o6", "p", "0.1", "batch_2", "other"), ("o6", "p", "0.1", "batch_2", "other")]
    landed = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in columns))
    texts = {c: F.lit(None).cast("string") for c in RAW_COLUMNS if c not in columns}
    stamps = {"ingestion_ts": F.lit("2024-01-01").cast("timestamp"), "ingestion_date": F.lit("2024-01-01").cast("date")}
    landed.withColumns(texts | stamps | {"source_file": F.lit("f"), "source_system": F.lit("s")}).write.parquet(path)
    bronze = spark.read.parquet(path)
    for each_batch, plain in ((False, transform_to_silver), (True, transform_batches_to_silver)):
        for most in (0, 1000):
            assert spark_bag(stored_to_silver(bronze, each_batch, most)) == spark_bag(plain(bronze)), (each_batch, most)
    alone, repeated = split_by_repeated_keys(bronze)
    assert {r["Order ID"] for r in repeated.collect()} == {"o1", "o5", "o6"}
    assert alone.count() + repeated.count() == len(rows)
    wide = [line for line in plan_of(stored_to_silver(bronze)).splitlines() if "Exchange hashpartitioning(order_id" in line]
    assert len(wide) == 1 and "BroadcastHashJoin" in plan_of(alone)
