"""Distinct orders merged from batches against counting all lines."""

import pytest
from pyspark.sql import functions as F

from goldpan.operators import sinks
from goldpan.plans import distinct_orders, medallion
from tests.compare import spark_bag

SCHEMA = "order_id string, order_date timestamp_ntz, category string, region string, segment string, sales double, profit double, quantity int"
# Orders come back in later batches, in the same and in other groups; groups and orders may be missing.
LINES = {
    1: [("o1", "c1", "r1"), ("o1", "c1", "r1"), ("o1", "c2", "r1"), ("o2", "c1", None), (None, "c3", "r3")],
    2: [("o1", "c1", "r1"), ("o3", "c1", "r1"), ("o2", "c1", "r1"), ("", "c1", "r1")],
    3: [],
    4: [(f"x{i}", "c9", "r1") for i in range(3000)] + [(f"x{i}", "c9", "r2") for i in range(0, 3000, 7)],
}


def put(lake, number, lines):
    rows = [(o, None, c, r, "s", 1.5, 0.25, 2) for o, c, r in lines]
    batch = lake.spark.createDataFrame(rows, SCHEMA).withColumn("order_date", F.lit("2024-02-03").cast("timestamp_ntz"))
    sinks.replace_one_partition(batch, lake.silver, "batch_id", f"batch_{number}")


def check(lake):
    silver = lake.read(lake.silver).withColumns({"year": F.year("order_date"), "month": F.month("order_date")})
    for name, keys in distinct_orders.REPORTS.items():
        expected = silver.groupBy(*keys).agg(
            F.round(F.sum("sales"), 2).alias("total_sales"),
            F.round(F.sum("profit"), 2).alias("total_profit"),
            F.sum("quantity").alias("total_quantity"),
            F.count_distinct("order_id").alias("order_count"),
        )
        assert spark_bag(distinct_orders.report(lake, name)) == spark_bag(expected)


@pytest.fixture
def lake(spark, tmp_path):
    return medallion.Medallion(spark, str(tmp_path))


@pytest.mark.parametrize("buckets", [1, 5])
def test_after_every_batch_as_counted_over_all(lake, buckets):
    for number in (4, 2, 1, 3):
        put(lake, number, LINES[number])
        distinct_orders.add_batch(lake, number, buckets)
    check(lake)
    put(lake, 2, LINES[2][:1])  # a batch that comes again with other rows
    distinct_orders.add_batch(lake, 2, buckets)
    check(lake)


def test_numbers_are_dense_and_never_change(lake):
    for number in (1, 2):
        put(lake, number, LINES[number])
        distinct_orders.add_batch(lake, number, 2)
    before = spark_bag(distinct_orders.dictionary_of(lake))
    distinct_orders.add_batch(lake, 1, 2)
    assert spark_bag(distinct_orders.dictionary_of(lake)) == before
    numbers = distinct_orders.dictionary_of(lake).groupBy("order_bucket").agg(
        F.max("order_no").alias("top"), F.count_distinct("order_no").alias("n"), F.count("*").alias("rows")
    )
    assert all(r.top == r.n == r.rows for r in numbers.collect())


def test_a_run_that_failed_while_numbering_is_finished_by_the_next(lake, spark):
    put(lake, 4, LINES[4])
    some = spark.createDataFrame([(f"x{i}",) for i in range(0, 3000, 2)], "order_id string")
    distinct_orders.number_orders(lake, some, "batch_4", 3)
    distinct_orders.add_batch(lake, 4, 3)
    check(lake)


def test_sketch_is_near(lake):
    put(lake, 4, LINES[4])
    put(lake, 2, LINES[2])
    for number in (4, 2):
        distinct_orders.add_batch(lake, number, 2)
    count = {r.region: r.order_count for r in distinct_orders.report(lake, "by_region", sketch=True).collect()}
    assert abs(count["r1"] - 3004) < 4 * distinct_orders.SKETCH_ERROR * 3004


def test_older_batches_are_not_read(lake):
    for number in (1, 2):
        put(lake, number, LINES[number])
        distinct_orders.add_batch(lake, number, 2)
    lake.spark.createDataFrame([("gone",)], "unrelated string").write.mode("overwrite").parquet(f"{lake.silver}/batch_id=batch_1")
    put(lake, 4, LINES[4])
    distinct_orders.add_batch(lake, 4, 2)
    categories = {r.category: r.order_count for r in distinct_orders.report(lake, "by_category").collect()}
    assert categories == {"c1": 4, "c2": 1, "c3": 0, "c9": 3000}
