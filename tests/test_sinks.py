from goldpan.operators import sinks

NAME = "spark.sql.maxConcurrentOutputFileWriters"


def test_partitions_are_written_side_by_side(spark, tmp_path, monkeypatch):
    """No task sorts its rows by partition, the setting is put back, and more partitions than writers are all there."""
    seen = []
    writer = type(spark.range(1).write)
    for method in ("save", "parquet"):
        kept = getattr(writer, method)

        def watched(self, *args, kept=kept, **kwargs):
            seen.append(int(spark.conf.get(NAME)))
            return kept(self, *args, **kwargs)

        monkeypatch.setattr(writer, method, watched)
    before = spark.conf.get(NAME)
    rows = spark.range(0, 700, 1, 3).selectExpr("id", "date_add(date'2024-01-01', cast(id % 7 as int)) as ingestion_date")
    path = str(tmp_path / "bronze")
    sinks.create_bronze_table(rows, path)
    sinks.append_to_bronze(rows, path)
    sinks.replace_partitions(rows.where("id % 7 = 2"), path, ["ingestion_date"])
    assert seen[0] == seen[1] == seen[-1] == sinks.WRITERS and spark.conf.get(NAME) == before
    counts = sinks.read_table(spark, path).groupBy("ingestion_date").count().collect()
    assert sorted(r["count"] for r in counts) == [100] + [200] * 6
