import duckdb
import pytest
from pyspark.sql import functions as F

from goldpan.llm import mixing
from goldpan.llm.oracles import OP4


def by_rounds(sizes, weights=(3, 1, 2)):
    """Targets by sharing the excess again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, open_ = dict.fromkeys(names, 0.0), 1.5 * sum(sizes.values()), set(names)
    while left > 1e-9 and open_:
        total = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += left * weight[s] / total
        left = 0.0
        for s in list(open_):
            if target[s] > 2 * sizes[s]:
                left += target[s] - 2 * sizes[s]
                target[s] = 2.0 * sizes[s]
                open_.discard(s)
    return target


@pytest.fixture(scope="module")
def rows():
    out = [(i, "w " * (i * 37 % 50 + 1), f"s{i % 3}") for i in range(3000)]
    out += [(10_000 + i, "one two three", "hot") for i in range(2000)]
    out += [(20_000 + i, None, "silent") for i in range(5)] + [(30_000 + i, "a b", None) for i in range(50)]
    return out


def test_targets_and_taken_words(documents, rows):
    mixed = mixing.mix(documents(rows)).toPandas()
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    expected = by_rounds(sizes)
    source = {i: s for i, _, s in rows}
    mixed["source"] = [source[i] for i in mixed["doc_id"]]
    for s, part in mixed.groupby("source", dropna=False):
        s = s if isinstance(s, str) else None
        assert part["target"].iloc[0] == pytest.approx(expected[s])
        assert abs(part["taken"].sum() - expected[s]) <= 2 * part["size"].max() + 1
    assert (mixed["taken"] <= 2 * mixed["size"]).all()
    assert len(mixed) == len(rows)
    again = mixing.mix(documents(rows[::-1])).toPandas()
    assert dict(zip(mixed.doc_id, mixed.taken)) == dict(zip(again.doc_id, again.taken))


def test_odd_and_empty(odd, empty):
    assert mixing.mix(odd).count() == odd.count()
    assert mixing.mix(odd).where("taken > 2 * size or taken is null").isEmpty()
    assert mixing.mix(empty).isEmpty()


def test_words_nowhere(documents):
    assert {r.taken for r in mixing.mix(documents([(1, None, "a"), (2, " ", "b")])).collect()} == {0}


def test_another_seed_moves_the_offset(documents, rows):
    one, two = (mixing.mix(documents(rows), seed=s).where("taken > 0").count() for s in ("a", "b"))
    assert one > 0 and two > 0


def test_sql_agrees_on_odd_sources(documents, rows):
    frame = documents(rows).select("doc_id", "text", "source").toPandas()
    connection = duckdb.connect()
    connection.register("documents", frame)
    expected = sorted(connection.execute(OP4).fetchall())
    mixed = mixing.mix(documents(rows)).select("doc_id", "size", "source_size", "target", "taken")
    assert sorted(map(tuple, mixed.collect())) == expected


def test_salts_follow_the_count_and_deal_out_any_ids(documents, rows):
    """The same sums hold with many short salts, also where ids are null or share a factor."""
    shared = [(None if i % 2 else i * 4096, t, s) for i, t, s in rows]
    whole = mixing.mix(documents(shared)).groupBy("source_size", "target").sum("taken", "copies").collect()
    salted = mixing.mix(documents(shared), per_salt=7).groupBy("source_size", "target").sum("taken", "copies").collect()
    near = {(r[0], r[1]): r for r in whole}
    for r in salted:
        assert abs(r[2] - near[r[0], r[1]][2]) <= 2 * 50 + 1
        assert abs(r[3] - near[r[0], r[1]][3]) <= 1
    narrow = mixing.sized(documents(shared), "doc_id", "text", "source").where("doc_id is not null and size = 3")
    dealt = narrow.groupBy((F.col("spread") % 8).alias("salt")).count()
    assert dealt.count() == 8
    assert max(r[1] for r in dealt.collect()) < 2 * narrow.count() / 8
