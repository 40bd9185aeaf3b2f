"""Facts that hold without an oracle, and the counts written down for the supplied data."""

import pytest
from pyspark.sql import functions as F

from goldpan.operators import reports
from goldpan.operators.gold import create_sales_by_category_region
from goldpan.operators.issues import assign_batches, generate_batches, introduce_quality_issues
from goldpan.operators.silver import type_raw_columns
from goldpan.queries import all_queries
from goldpan.schema import RAW_COLUMNS
from goldpan.sources import sales_view as view
from goldpan.sources.csv_batches import read_sales_csv
from goldpan.storage import shared_folder

EXPECTED = {
    "/root/testdata/sf0.001": {
        "batches": [1940, 2078, 2036],
        "silver": 5821,
        "sales": 307509583.50,
        "quantity": 69,
        "discount": 60,
        "groups": 30,
        "products": 199,
    },
    "/root/testdata/sf0.01": {
        "batches": [20150, 20263, 20155],
        "silver": 58747,
        "sales": 3115839857.85,
        "quantity": 614,
        "discount": 581,
        "groups": 30,
        "products": 1789,
    },
}


@pytest.mark.parametrize("sf_dir", EXPECTED)
def test_known_counts(spark, sf_dir):
    expected = EXPECTED[sf_dir]
    names = ("by_batch", "quality_checks", "gold_totals", "gold_products")
    run = {name: all_queries()[name](spark, sf_dir) for name in names}
    assert [r.record_count for r in run["by_batch"].collect()] == expected["batches"]
    checks = run["quality_checks"].first()
    assert checks.total_records == expected["silver"]
    assert (checks.invalid_quantity, checks.invalid_discount) == (expected["quantity"], expected["discount"])
    totals = run["gold_totals"].first()
    assert totals.global_sales == expected["sales"]
    assert totals.global_orders == expected["silver"]
    assert totals.category_region_combinations == expected["groups"]
    assert run["gold_products"].count() == expected["products"]


@pytest.mark.parametrize("sf_dir", EXPECTED)
def test_no_orphans_and_unique_dimension_keys(spark, sf_dir):
    """What leaving dimensions out of the sales view rests on."""
    names = ("lineitem", "orders", "customer", "nation", "region", "part")
    tables = {name: view.table(spark, sf_dir, name) for name in names}
    for child, key, parent, parent_key in (
        ("lineitem", "l_orderkey", "orders", "o_orderkey"),
        ("lineitem", "l_partkey", "part", "p_partkey"),
        ("orders", "o_custkey", "customer", "c_custkey"),
        ("customer", "c_nationkey", "nation", "n_nationkey"),
        ("nation", "n_regionkey", "region", "r_regionkey"),
    ):
        assert tables[child].join(tables[parent], F.col(key) == F.col(parent_key), "left_anti").isEmpty()
        assert tables[parent].groupBy(parent_key).count().where("count > 1").isEmpty()


def test_zero_sales_give_no_margin(spark):
    silver = spark.sql("select 'o' order_id, 'c' category, 'r' region, 0D sales, 1D profit, 1 quantity")
    gold = create_sales_by_category_region(silver)
    assert reports.best_combinations(gold).first().profit_margin_pct is None
    assert reports.gold_by_region(gold).first().profit_margin_pct is None
    assert reports.executive_kpis(gold).first().global_profit_margin_pct is None


@pytest.mark.parametrize("rate, copies", [(0.05, 0.01), (0.002, 0.0004), (0.0004, 0.0004)])
def test_issue_rates(spark, rate, copies):
    rows = 400_000
    clean = spark.range(rows).select(
        F.col("id").cast("string").alias("Order ID"),
        F.col("id").cast("string").alias("Product ID"),
        F.lit(1.0).alias("Sales"),
        F.lit(5).alias("Quantity"),
        F.lit(0.1).alias("Discount"),
    )
    dirty = introduce_quality_issues(clean, rate, copies)
    counts = dirty.agg(
        F.count("*").alias("n"),
        F.count_if(F.col("Sales").isNull()).alias("s"),
        F.count_if(F.col("Product ID").isNull()).alias("p"),
        F.count_if(~F.col("Discount").between(0, 1)).alias("d"),
        F.count_if(F.col("Quantity") <= 0).alias("q"),
    ).first()

    def near(found, expected):
        return abs(found - expected) <= 5 * expected**0.5

    assert near(counts.n - rows, copies * rows)
    for issue in (counts.s, counts.p, counts.d, counts.q):
        assert near(issue, rate * rows / 5)
    assert introduce_quality_issues(clean, rate, copies).exceptAll(dirty).isEmpty()


def test_batches_partition_the_source(spark, tiny, tmp_path):
    source = view.bronze(spark, tiny).drop("ingestion_date", "ingestion_ts", "source_file", "source_system", "batch_id")
    key = F.col("Order ID").cast("bigint")
    sizes = {r.batch_no: r["count"] for r in assign_batches(source, key, 4).groupBy("batch_no").count().collect()}
    assert sorted(sizes) == [1, 2, 3, 4] and sum(sizes.values()) == source.count()
    paths = generate_batches(source, str(tmp_path / "landing"), key, num_batches=2, issue_rate=0.0)
    landed = [type_raw_columns(read_sales_csv(spark, p)) for p in paths]
    assert [tuple(df.columns) for df in landed] == [RAW_COLUMNS, RAW_COLUMNS]
    union = landed[0].unionByName(landed[1])
    assert source.select(*RAW_COLUMNS).exceptAll(union).isEmpty()


def test_shared_folder_comes_from_the_session(spark, tmp_path):
    before = spark.conf.get("spark.checkpoint.dir", None)
    assert before is None or shared_folder(spark) == before


def test_queries_leave_the_settings_alone(spark, tiny):
    def settings():
        return {r.key: r.value for r in spark.sql("SET").collect()}

    before = settings()
    for name in ("silver_full_refresh", "gold_products"):
        all_queries()[name](spark, tiny).count()
    assert settings() == before
