"""File listings against the file system."""

import glob
import os

import pytest

from goldpan.operators import sinks
from goldpan.queries import all_queries
from goldpan.sources import sales_view
from goldpan.sources.files import data_files, files_per_partition, partitions
from tests.compare import spark_bag


@pytest.fixture(scope="module")
def bronze_path(spark, tiny, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables") / "bronze")
    rows = sales_view.bronze(spark, tiny, "Order ID", "Sales").repartition(3)
    sinks.create_bronze_table(rows, path)
    return path


def on_disk(path):
    return {f: os.path.getsize(f) for f in glob.glob(f"{path}/ingestion_date=*/*.parquet")}


def test_every_data_file_is_listed_with_its_size(spark, bronze_path):
    listed = data_files(sinks.read_table(spark, bronze_path), ("ingestion_date",)).collect()
    assert {r.file_path.removeprefix("file:"): r.file_size_in_bytes for r in listed} == on_disk(bronze_path)
    assert {r.file_format for r in listed} == {"PARQUET"}
    assert sum(r.record_count for r in listed) == spark.read.parquet(bronze_path).count()


def test_listing_reads_no_data_column(spark, bronze_path):
    plan = data_files(sinks.read_table(spark, bronze_path))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan


def test_totals_per_partition(spark, bronze_path):
    files = data_files(sinks.read_table(spark, bronze_path), ("ingestion_date",))
    totals = files_per_partition(files).collect()
    disk = on_disk(bronze_path)
    assert sum(t.file_count for t in totals) == len(disk)
    assert sum(t.total_size_bytes for t in totals) == sum(disk.values())
    by_partition = partitions(sinks.read_table(spark, bronze_path), ("ingestion_date",)).collect()
    assert {r.ingestion_date: r.record_count for r in by_partition} == {t.ingestion_date: t.total_records for t in totals}


def test_listings(spark, tiny):
    rows = all_queries()["files_by_partition"](spark, tiny).collect()
    assert [r.total_records for r in rows] == [2036, 2078, 1940]
    assert all_queries()["landing_inventory"](spark, tiny).count() == 3


def test_sinks_keep_the_rows_and_refuse_to_overwrite(spark, tiny, tmp_path):
    rows = sales_view.bronze(spark, tiny, "Order ID", "Sales")
    path = str(tmp_path / "t")
    sinks.create_bronze_table(rows, path)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        sinks.create_bronze_table(rows, path)
    sinks.append_to_bronze(rows, path)
    assert sinks.read_table(spark, path).count() == 2 * rows.count()
    sinks.create_or_replace_table(rows, path)
    assert spark_bag(sinks.read_table(spark, path).select("Order ID", "Sales", "batch_id")) == spark_bag(
        rows.select("Order ID", "Sales", "batch_id")
    )


def test_tables_by_name(spark, tiny):
    rows = sales_view.bronze(spark, tiny, "Order ID", "Sales")
    name = "named_bronze"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    try:
        assert not sinks.table_exists(spark, name)
        for _ in range(2):
            for batch in ("batch_1", "batch_2"):
                sinks.replace_partitions(rows.where(f"batch_id = '{batch}'"), name, sinks.BATCH_PARTITION)
        stored = sinks.read_table(spark, name)
        assert {r.batch_id: r["count"] for r in stored.groupBy("batch_id").count().collect()} == {
            "batch_1": 1940,
            "batch_2": 2078,
        }
        sinks.create_or_replace_table(rows, name)
        assert sinks.read_table(spark, name).count() == rows.count()
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
