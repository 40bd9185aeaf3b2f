import hashlib

import pytest
from pyspark.sql import functions as F

from goldpan.llm import exact_dedup as ed
from goldpan.llm.common import without
from goldpan.storage import fresh_path, materialize
from tests.llm.conftest import ODD_ROWS, bag


def expected(rows):
    groups = {}
    for i, t, _ in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for t, ids in groups.items():
        keep = max(ids, key=lambda i: (i is not None, i or 0))
        stays = 0
        for i in sorted(ids, key=lambda i: (i is None, -(i or 0))):
            kept = i == keep and not stays
            stays += kept
            out.append((i, keep, len(ids), kept, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_odd_rows(odd):
    found = ed.exact_dedup(odd).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert bag(found) == expected(ODD_ROWS)


def test_large_group_is_compared_in_parts(documents):
    rows = [(i, "one text" if i % 3 else f"text {i}", "s") for i in range(500)]
    found = ed.exact_dedup(documents(rows), rows_per_check=7)
    assert bag(found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")) == expected(rows)


def test_empty(empty):
    assert ed.exact_dedup(empty).count() == 0
    assert ed.drop_copies(empty).columns == empty.columns


def test_drop_copies_keeps_all_columns(odd):
    left = ed.drop_copies(odd)
    assert left.columns == odd.columns
    assert left.count() == len({t or "" for _, t, _ in ODD_ROWS})


def test_parquet_is_read_in_place(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    assert "locator_row" in ed.with_locator(docs).columns
    assert ed.drop_copies(docs).count() == docs.select(F.coalesce("text", F.lit(""))).distinct().count()


def test_state_goes_on_with_later_files(spark):
    path, checkpoint = fresh_path(spark, "in"), fresh_path(spark, "state")
    schema = "digest string, doc_id long, locator_file long, locator_row long"
    for rows in ([("a", 1, 1, 1), ("b", 2, 1, 2)], [("a", 7, 2, 1), ("c", 3, 2, 2)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        ed.update_state(ed.digest_stream(spark, path, 1), checkpoint)
    state = {r.digest: (r.keeper.doc_id, r.group_size) for r in ed.read_state(spark, checkpoint).collect()}
    assert state == {"a": (7, 2), "b": (2, 1), "c": (3, 1)}


def test_no_python_in_the_plan(odd):
    plan = ed.exact_dedup(odd)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_settings_are_put_back(spark, odd):
    before = {k: spark.conf.get(k, None) for k in ed._STATE}
    ed.exact_dedup(odd).count()
    assert {k: spark.conf.get(k, None) for k in ed._STATE} == before


def test_a_collision_stops_the_run(spark, monkeypatch, documents):
    monkeypatch.setattr(ed.F, "sha2", lambda c, n: F.lit("same"))
    with pytest.raises(Exception, match="share a digest"):
        ed.exact_dedup(documents([(1, "a", "s"), (2, "b", "s")])).collect()


@pytest.mark.parametrize("most", [0, 1000])
def test_copies_go_by_broadcast_and_by_shuffle(odd, documents, most):
    """Both ways leave the same rows, null ids and repeated rows included."""
    key = F.struct(F.col("doc_id").alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"))
    gone = materialize(odd.where("doc_id is null or doc_id in (5, 9)").select(key.alias("gone")).distinct(), "gone")
    joined = without(odd, gone, key == F.col("gone"), most)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in plan) == (most > 0)
    assert bag(joined) == bag(odd.where("doc_id is not null and doc_id not in (5, 9)"))
