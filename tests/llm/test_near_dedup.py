import random

import pytest

from goldpan.llm import common
from goldpan.llm import near_dedup as nd
from tests.llm.conftest import ODD_ROWS


def brute(rows):
    shingles = nd.Shingles()
    sets = [set(shingles((t or "").encode()).tolist()) for _, t, _ in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 4 * len(a & b) >= 3 * len(a | b):
                parent[root(i)] = root(j)
    out = []
    for i, (doc, _, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        least = (min(ids) if ids else None) if sets[i] else doc
        out.append((doc, len(sets[i]), least, doc == least))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r)[:4] for r in nd.near_dedup(df).collect()), key=repr)


def test_shingle_hash_is_one_of_the_words():
    s = nd.Shingles()
    assert len(s(b"a b c d e f")) == 2
    assert len(s(b"A B")) == 1 and (s(b"a b") == s(b"A\tB ")).all()
    assert len(s(b" ")) == 0
    assert not set(s(b"a b c d e").tolist()) & set(s(b"b a c d e").tolist())


@pytest.mark.parametrize("short", [2, 32])
def test_against_brute_force(documents, monkeypatch, short):
    """Copies with some words changed, a passage that many share, one large group."""
    monkeypatch.setattr(nd, "SHORT_LIST", short)
    draw = random.Random(short)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [draw.choice(vocabulary) for _ in range(25)]
    rows = []
    for group, copies in enumerate((60, 8, 3, 2, 1, 1)):
        base = [draw.choice(vocabulary) for _ in range(draw.randrange(60, 160))]
        for _ in range(copies):
            words = list(base)
            for _ in range(draw.randrange(0, 5)):
                words[draw.randrange(len(words))] = draw.choice(vocabulary)
            if draw.random() < 0.3:
                words += passage
            rows.append((len(rows) * 7 % 101 + 1000 * group, " ".join(words), "s"))
    rows += [(9000 + i, " ".join([f"u{i}x{j}" for j in range(8)] + passage), "s") for i in range(40)]
    draw.shuffle(rows)
    assert found(documents(rows)) == brute(rows)


def test_odd_and_empty(odd, empty):
    assert found(odd) == brute(ODD_ROWS)
    assert found(empty) == []
    left = nd.drop_near_copies(odd)
    assert left.columns == odd.columns
    assert left.where("text is null or trim(text) = ''").count() >= 2
    assert nd.drop_near_copies(empty).isEmpty()


def test_components(spark):
    edges = [(bytes([a]), bytes([b])) for a, b in ((1, 2), (3, 2), (3, 4), (9, 8), (7, 9), (5, 4), (5, 6))]
    roots = {bytes(r.node): bytes(r.root) for r in nd.components(spark.createDataFrame(edges, "a binary, b binary")).collect()}
    assert {k[0]: v[0] for k, v in roots.items()} | {1: 1, 7: 7} == {
        **dict.fromkeys(range(1, 7), 1),
        **dict.fromkeys((7, 8, 9), 7),
    }


def test_rows_of_lists_are_shuffled_once(documents):
    """Counting who holds a value and picking those rows is one pass, and nothing is computed twice."""
    held = documents([(1, "a", "s")]).selectExpr("class_key", "1L as n_shingles", "1 as k", "doc_id as value")
    plan = nd.inverted_lists(held, nd.F.lit(1))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(value") == 2


def test_texts_of_other_rows_stay_where_they_are(documents):
    rows = documents([(i, f"text {i}", "s") for i in range(20)]).select("doc_id", "text", "lang")
    wanted = rows.filter("doc_id in (3, 4)").select("doc_id", "text")
    assert sorted(r.doc_id for r in common.likely_among(rows, wanted, ["doc_id", "text"]).collect()) == [3, 4]
    assert common.likely_among(rows, wanted, ["doc_id", "text"], most_hashes=1).count() == 20
