"""Clustered tables: the same rows, and lookups that read few of them."""

import datetime

import pytest
from pyspark.sql import functions as F

from goldpan.operators import layout

ROWS = 200_000
SMALL_GROUPS = {"parquet.block.size": "65536", "parquet.page.size": "16384", "parquet.page.write-checksum.enabled": "false"}


@pytest.fixture(scope="module")
def sales(spark):
    spread = F.xxhash64("id")
    return spark.range(ROWS).select(
        F.concat(F.lit("o"), F.pmod(spread, F.lit(60_000))).alias("order_id"),
        F.concat(F.lit("c"), F.pmod(F.xxhash64(spread), F.lit(100_000))).alias("customer_id"),
        F.date_add(F.lit(datetime.date(2020, 1, 1)), F.pmod(F.xxhash64(spread, "id"), F.lit(1000)).cast("int")).alias("order_date"),
        (F.pmod(F.xxhash64("id", spread), F.lit(1_000_000)) / 100).alias("sales"),
        F.when(F.col("id") % 7 > 0, F.col("id")).alias("note"),
    )


@pytest.fixture(scope="module")
def clustered(spark, sales, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("layout") / "table")
    layout.write_clustered(
        sales, path, ["order_date", "sales"], ["order_id", "customer_id"], files=256, keys_per_row_group=4000, **SMALL_GROUPS
    )
    return spark.read.parquet(path)


def rows_read(df):
    """Rows that the scan hands on, after it has left out row groups."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.head().metrics().apply("numOutputRows").value()


def test_the_same_rows(sales, clustered):
    assert clustered.count() == ROWS
    assert sales.exceptAll(clustered).isEmpty()


@pytest.mark.parametrize("key,value", [("order_id", "o77"), ("customer_id", "c4243")])
def test_a_key_is_found_in_few_rows(sales, clustered, key, value):
    found = layout.lookup(clustered, key, [value])
    assert sorted(found.collect()) == sorted(layout.lookup(sales, key, [value]).collect())
    assert found.count() > 0
    assert rows_read(layout.lookup(clustered, key, [value])) < ROWS / 10


@pytest.mark.parametrize(
    "box,share",
    [
        # A range of one of two columns meets one or two of the 16 strips that 256 files make.
        ({"order_date": (datetime.date(2021, 3, 1), datetime.date(2021, 3, 20))}, 0.15),
        ({"sales": (9800.0, None)}, 0.15),
        ({"order_date": (datetime.date(2021, 3, 1), datetime.date(2021, 6, 1)), "sales": (None, 500.0)}, 0.1),
    ],
)
def test_a_range_of_either_column_reads_few_rows(sales, clustered, box, share):
    found = layout.in_box(clustered, box)
    assert found.count() == layout.in_box(sales, box).count() > 0
    assert rows_read(layout.in_box(clustered, box)) < ROWS * share


def test_places_and_interleaving(spark):
    cuts = [10, 20, 30]
    frame = spark.createDataFrame([(None,), (9,), (10,), (25,), (30,), (99,)], "x int")
    assert [r[0] for r in frame.select(layout.place(F.col("x"), cuts)).collect()] == [0, 0, 1, 2, 3, 3]
    pairs = [(a, b) for a in range(8) for b in range(8)]
    keys = spark.createDataFrame(pairs, "a int, b int").select("a", "b", layout.interleaved([F.col("a"), F.col("b")], 3)).collect()
    for a, b, key in keys:
        assert key == int("".join(y + x for x, y in zip(f"{a:03b}", f"{b:03b}", strict=True)), 2)


def test_one_box_with_all_rows_fills_several_files(spark, tmp_path):
    same = spark.range(10_000).select("id", F.lit(1.0).alias("sales"))
    layout.write_clustered(same, str(tmp_path / "t"), ["sales"], files=8)
    counts = [r[0] for r in spark.read.parquet(str(tmp_path / "t")).groupBy(F.input_file_name()).count().select("count").collect()]
    assert len(counts) == 8 and max(counts) < 2 * 10_000 / 8


@pytest.mark.parametrize("value", ["null", "none"])
def test_nulls_and_empty_tables(spark, tmp_path, value):
    frame = spark.createDataFrame([(None, None)] * 3 if value == "null" else [], "order_id string, sales double")
    layout.write_clustered(frame, str(tmp_path / "t"), ["sales"], ["order_id"])
    assert spark.read.parquet(str(tmp_path / "t")).count() == frame.count()


def test_too_wide_a_key(sales, tmp_path):
    with pytest.raises(ValueError):
        layout.write_clustered(sales, str(tmp_path / "t"), ["order_date", "sales"], bits=32)
