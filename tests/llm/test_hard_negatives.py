import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from goldpan.llm import hard_negatives
from goldpan.llm.oracles import llm_oracles
from goldpan.llm.queries import op11_hard_negatives

COLUMNS = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def bag(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def brute_force(rows, every=5, positives=5, negatives=3):
    """All scores in Python's whole numbers."""
    usable = {
        (i, label, tuple(math.floor(256 * x) for x in v))
        for i, label, v in rows
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }

    def order(r):
        return -r[0], r[1] is None, r[1] or 0

    out = []
    for a, la, qa in usable:
        if a is None or a % every:
            continue
        scored = [(sum(x * y for x, y in zip(qa, q)), i, label) for i, label, q in usable]
        mine = sorted(((s, i) for s, i, label in scored if label == la and i != a), key=order)[:positives]
        for ps, p in mine:
            fit = sorted(((s, i) for s, i, label in scored if label != la and 50 * ps <= 100 * s <= 95 * ps), key=order)
            out += [(a, p, r, n, ps, ns) for r, (ns, n) in enumerate(fit[:negatives], start=1)]
    return sorted(out, key=repr)


def vectors(spark, rows):
    full = [(i, label, v, "x", "y", 1.0) for i, label, v in rows]
    return spark.createDataFrame(full, "vec_id long, label int, embedding array<float>, block string, q string, anchor double")


def found(spark, rows, **options):
    return bag(hard_negatives.mine(vectors(spark, rows), F.col("vec_id") % 5 == 0, **options))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_same_rows_as_sql(spark, sf):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM '/root/testdata/{sf}/embeddings.parquet'")
    expected = duck.execute(f"SELECT {', '.join(COLUMNS)} FROM ({llm_oracles()['op11_hard_negatives']})").fetchall()
    assert expected and bag(op11_hard_negatives(spark, f"/root/testdata/{sf}")) == sorted(expected, key=repr)


def _some(n, dims, labels, seed, steps=8):
    """Coarse components, so that scores tie."""
    r = np.random.default_rng(seed)
    grid = np.round(r.normal(size=(n, dims)) * steps) / steps
    return [(i, int(r.integers(labels)), v) for i, v in enumerate(grid.tolist())]


def test_blocks_and_clusters_change_nothing(spark):
    rows = _some(400, 6, 3, 1)
    expected = brute_force(rows)
    assert expected
    for options in ({}, {"block_rows": 60, "members": 10, "most_clusters": 4, "fit_rows": 20}):
        assert found(spark, rows, **options) == expected


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = _some(60, 4, 2, 2)
    rows += rows[10:20]  # repeated
    rows += [(i, 1 - label, v) for i, label, v in rows[20:30]]  # same id and vector, another label
    rows += [(25, 0, [0.5, 0.25, 1.0, -1.0]), (25, 0, [0.5, 0.25, 1.0, 1.0])]
    rows += [(None, 0, [1.0, 1.0, 1.0, 1.0]), (None, 1, [1.0, 1.0, 1.0, 1.0])]
    rows += [(100, None, [1.0] * 4), (105, 1, None), (110, 1, [1.0, None, 1.0, 1.0]), (115, 0, [nan] * 4), (120, 1, [-inf, 1.0, 1.0, 1.0])]
    rows += [(125, 0, [0.0] * 4), (130, 1, []), (135, 0, [2.0]), (140, 7, [1.0] * 4)]
    padded = [(i, label, v if v is None else v + [0.0] * (4 - len(v))) for i, label, v in rows]
    assert found(spark, rows, block_rows=16, members=4) == brute_force(padded)


def test_a_hot_group_of_equal_vectors(spark):
    rows = _some(60, 4, 3, 3) + [(1000 + i, i % 2, [1.0, 0.5, 0.0, 0.25]) for i in range(80)]
    assert found(spark, rows, block_rows=20) == brute_force(rows)


def test_walks_end_early_and_are_certified():
    """Tight groups: a member's walk stops within its own, and finds what all scores find."""
    r = np.random.default_rng(4)
    heart = np.eye(16)
    rows = np.concatenate([np.floor(256 * (heart[g] + 0.02 * r.normal(size=(400, 16)))) for g in range(16)])
    ids, labels = np.arange(len(rows)), np.zeros(len(rows), np.int64)
    block = hard_negatives.Candidates(ids, labels, rows)
    members = rows[800:840]
    centroid, _ = hard_negatives.directions(members.mean(axis=0, keepdims=True))
    unit, _ = hard_negatives.directions(members)
    block.sort_for(0, centroid[0], float(hard_negatives.angles(unit, centroid[0]).max()))
    scored = 0
    plain = block.keys

    def counted(m, at):
        nonlocal scored
        scored += len(m) * len(at)
        return plain(m, at)

    block.keys = counted
    best = block.positives(ids[800:840], labels[800:840], members, 5)
    everything = members @ rows.T
    everything[np.arange(40), 800 + np.arange(40)] = -(10**9)
    assert (best >> hard_negatives.RANK_BITS).tolist() == (-np.sort(-everything, axis=1)[:, :5]).astype(int).tolist()
    assert scored < 0.3 * everything.size


def test_empty_tables_and_no_anchors(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, 0, [1.0]), (2, 1, [1.0])]) == []
    assert found(spark, [(5, 0, [1.0])]) == []


def test_scores_too_large_to_hold_stop_the_run(spark):
    with pytest.raises(Exception, match="scores beyond"):
        found(spark, [(5, 0, [1e7]), (6, 0, [1e7])])
