"""Contiguous batches with exact numbers of issues."""

import pytest
from pyspark.sql import functions as F

from goldpan.operators import exact_batches as exact

CLEAN = ("Order ID", "Product ID", "Sales", "Quantity", "Discount")


def lines(spark, n, path, files=3):
    rows = spark.range(n).select(
        F.col("id").cast("string").alias("Order ID"),
        F.lit("p").alias("Product ID"),
        F.lit(1.0).alias("Sales"),
        F.lit(5).alias("Quantity"),
        F.lit(0.1).alias("Discount"),
    )
    rows.repartitionByRange(files, F.col("Order ID").cast("long")).write.parquet(str(path))
    return spark.read.parquet(str(path))


@pytest.mark.parametrize(("n", "batches"), [(100, 3), (7, 3), (2, 3), (0, 2), (9, 1)])
def test_positions_and_sizes(spark, tmp_path, n, batches):
    rows, sizes = exact.split_contiguous(lines(spark, n, tmp_path / "t"), batches)
    found = sorted((int(r["Order ID"]), r.position, r.batch_no) for r in rows.collect())
    assert [(i, p) for i, p, _ in found] == [(i, i) for i in range(n)]
    size = n // batches
    assert [b for _, _, b in found] == [min(i // size, batches - 1) + 1 if size else batches for i in range(n)]
    assert sizes == [sum(b == k for _, _, b in found) for k in range(1, batches + 1)]


def test_a_filtered_or_joined_frame_has_no_gaps(spark, tmp_path):
    rows = lines(spark, 60, tmp_path / "t").where("`Order ID` % 7 != 0")
    numbered, total = exact.with_position(rows)
    assert sorted(r.position for r in numbered.collect()) == list(range(total)) and total == 51
    twice, total = exact.with_position(rows.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("copy")))
    assert sorted(r.position for r in twice.collect()) == list(range(102)) and total == 102


def test_exact_counts(spark, tmp_path):
    rows, sizes = exact.split_contiguous(lines(spark, 1003, tmp_path / "t"), 3)
    assert sizes == [334, 334, 335]
    dirty = exact.introduce_exact_issues(rows, sizes, 0.2, 0.05).collect()
    for batch, n in enumerate(sizes, start=1):
        mine = [r for r in dirty if r.batch_no == batch]
        assert len(mine) == n + int(n * 0.05)
        positions = {r.position: r for r in mine}
        assert len(positions) == n
        changed = [
            r for r in positions.values()
            if (r["Sales"], r["Product ID"], r["Quantity"], r["Discount"]) != (1.0, "p", 5, 0.1)
        ]
        # The kind "duplicate" changes nothing, so a fifth of the dirty rows looks clean.
        assert 0.6 * int(n * 0.2) < len(changed) <= int(n * 0.2)
        kinds = {(r["Sales"] is None, r["Product ID"] is None, r["Quantity"] != 5, r["Discount"] != 0.1) for r in changed}
        assert len(kinds) == 4 and all(sum(k) == 1 for k in kinds)


def test_no_rate_and_every_row(spark, tmp_path):
    rows, sizes = exact.split_contiguous(lines(spark, 20, tmp_path / "t"), 2)
    assert exact.introduce_exact_issues(rows, sizes, 0.0, 0.0).count() == 20
    assert exact.introduce_exact_issues(rows, sizes, 1.0, 1.0).count() == 40


def test_equal_draws_are_settled_by_position(spark):
    rows = spark.createDataFrame([(1, p) for p in range(10)] + [(2, p) for p in range(10, 13)], "batch_no int, position long")
    found = exact.first_draws(rows, F.lit(7).cast("long"), [4, 3])
    assert found == [(7, 3), (7, 12)]
    assert exact.first_draws(rows, F.col("position") * 100_000, [10, 1]) == [(900_000, 9), (1_000_000, 10)]


def test_scrambled_positions_do_not_repeat(spark):
    found = spark.range(50_000).select(exact.scrambled(F.col("id")).alias("s")).agg(F.count_distinct("s"), F.min("s"), F.max("s")).first()
    assert found[0] == 50_000 and 0 < found[1] and found[2] < exact.issues.PRIME


def test_batches_as_files(spark, tmp_path):
    source = lines(spark, 100, tmp_path / "t")
    folders = exact.generate_contiguous_batches(source, str(tmp_path / "out"), 3, columns=CLEAN)
    counts = [spark.read.option("header", True).csv(f).count() for f in folders]
    assert counts == [33, 33, 34]
