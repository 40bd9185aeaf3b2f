"""Silver written with its quarantine: nothing lost, reasons named, counters as counted afterwards."""

import pytest
from pyspark.sql import functions as F

from goldpan.operators import quality
from goldpan.operators.silver import transform_to_silver
from goldpan.plans import audited, medallion
from tests.compare import spark_bag
from tests.test_upsert import BATCHES, land

ODD = {
    1: [("o1", "p1", "ten"), ("o1", "p1", "9"), (None, None, None), (None, None, None), ("o2", None, "x")],
    2: [("o9", "p9", "-1")] * 5 + [("o1", "p1", "9"), ("", "", "0")],
}


@pytest.fixture(params=[BATCHES, ODD], ids=["plain", "odd"])
def lake(request, spark, tmp_path):
    lake = medallion.Medallion(spark, str(tmp_path))
    for number, rows in request.param.items():
        land(lake, number, rows)
    return lake


@pytest.mark.parametrize("salts", [1, 3, 1024])
def test_kept_rows_are_those_of_a_full_refresh(lake, salts):
    audited.run_silver_audited(lake, salts)
    bronze = lake.read(lake.bronze)
    assert spark_bag(audited.silver_of(lake)) == spark_bag(transform_to_silver(bronze))
    assert audited.silver_of(lake).count() + audited.quarantine_of(lake).count() == bronze.count()


def test_counters_equal_those_counted_afterwards(lake):
    audit = audited.run_silver_audited(lake)
    silver, bronze = audited.silver_of(lake), lake.read(lake.bronze)
    assert spark_bag(audit.quality_checks()) == spark_bag(quality.run_quality_checks(silver))
    assert spark_bag(audit.filter_rate()) == spark_bag(quality.filter_rate(bronze, silver))
    gone = audited.quarantine_of(lake)
    for kind, n in audit.reasons().items():
        assert gone.where(F.array_contains(F.split("reason", ","), kind)).count() == n


def test_reasons(spark, tmp_path):
    lake = medallion.Medallion(spark, str(tmp_path))
    for number, rows in ODD.items():
        land(lake, number, rows)
    audited.run_silver_audited(lake)
    found = {(r.batch_id, r.reason): r.records for r in audited.quarantine_summary(audited.quarantine_of(lake)).collect()}
    assert found == {
        ("batch_1", "unreadable_sales"): 1,
        ("batch_1", "null_order_id,null_product_id,null_sales"): 2,
        ("batch_1", "null_product_id,unreadable_sales"): 1,
        ("batch_2", "duplicate_key"): 5,
    }


def test_a_key_with_all_rows_meets_by_salt(spark, tmp_path):
    lake = medallion.Medallion(spark, str(tmp_path))
    land(lake, 1, [("o", "p", str(i)) for i in range(500)] + [("o", "p", "0")] * 500)
    counts = audited.run_silver_audited(lake, salts=8).counts
    assert (counts["silver_records"], counts["reason_duplicate_key"]) == (1, 999)
    assert audited.silver_of(lake).first().sales == 0


def test_no_rows(spark, tmp_path):
    lake = medallion.Medallion(spark, str(tmp_path))
    land(lake, 1, [("o", "p", None)])
    audit = audited.run_silver_audited(lake)
    assert audit.quality_checks().first().total_records == 0
    assert audited.silver_of(lake).count() == 0




def test_only_rows_of_repeated_keys_are_shuffled(lake):
    bronze = lake.read(lake.bronze)
    judged = [audited.judge_stored(bronze, 3, most) for most in (0, 1000)]
    assert spark_bag(judged[0]) == spark_bag(judged[1]) == spark_bag(audited.judge(bronze, 3))
    alone = judged[1]._jdf.queryExecution().executedPlan().toString().split("Exchange hashpartitioning")[0]
    assert "BroadcastHashJoin" in alone and "LeftAnti" in alone
