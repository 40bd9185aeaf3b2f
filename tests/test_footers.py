"""Footers say what a scan would count."""

import pytest
from pyspark.sql import functions as F

from goldpan.sources import footers


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("footers") / "a table")
    frame = spark.range(5000).select(
        "id",
        F.when(F.col("id") % 5 > 0, F.col("id") * 0.5).alias("half"),
        F.concat(F.lit("k"), F.col("id").cast("string")).alias("name"),
        F.lit(None).cast("string").alias("nothing"),
        F.struct((F.col("id") + 1).alias("inner")).alias("nested"),
        (F.col("id") % 3).cast("string").alias("region"),
        F.concat(F.lit("x:% y"), F.col("id") % 2).alias("odd"),
    )
    frame.repartition(4).write.partitionBy("odd").parquet(path)
    return path


def test_by_file(spark, folder):
    files = footers.file_statistics(spark, folder)
    rows = spark.read.parquet(folder).groupBy(F.col("_metadata.file_path").alias("path")).agg(
        F.count("*").alias("n"), F.min("id").alias("low"), F.max("id").alias("high"), F.count_if(F.col("half").isNull()).alias("gone")
    )
    expected = {(r.path.split("/")[-2][-1], r.path.split("/")[-1]): (r.n, r.low, r.high, r.gone) for r in rows.collect()}
    found = {}
    for r in files.where("column_name in ('id', 'half')").collect():
        found.setdefault((r.path.split("/")[-2][-1], r.path.split("/")[-1]), {})[r.column_name] = r
    assert {p: (f["id"].record_count, f["id"].min_number, f["id"].max_number, f["half"].null_count) for p, f in found.items()} == expected


def test_by_table(spark, folder):
    found = {r.column_name: r for r in footers.table_statistics(footers.file_statistics(spark, folder, files_per_task=1)).collect()}
    assert set(found) == {"id", "half", "name", "nothing", "nested.inner", "region"}
    assert {r.record_count for r in found.values()} == {5000}
    assert (found["half"].null_count, found["half"].min_number, found["half"].max_number) == (1000, 0.5, 2499.5)
    assert (found["name"].min_text, found["name"].max_text, found["name"].min_number) == ("k0", "k999", None)
    assert (found["nothing"].null_count, found["nothing"].min_text) == (5000, None)
    assert (found["nested.inner"].min_number, found["nested.inner"].max_number) == (1.0, 5000.0)


def test_no_bounds_where_one_file_has_none(spark, tmp_path):
    spark.range(10).select(F.lit(float("nan")).alias("x")).coalesce(1).write.parquet(str(tmp_path / "t"))
    spark.range(10).select(F.col("id").cast("double").alias("x")).coalesce(1).write.mode("append").parquet(str(tmp_path / "t"))
    row = footers.table_statistics(footers.file_statistics(spark, str(tmp_path / "t"))).first()
    assert (row.record_count, row.null_count, row.min_number, row.max_number) == (20, 0, None, None)


def test_empty_table(spark, tmp_path):
    spark.range(0).write.parquet(str(tmp_path / "t"))
    row = footers.table_statistics(footers.file_statistics(spark, str(tmp_path / "t"))).first()
    assert row is None or (row.record_count, row.min_number) == (0, None)
