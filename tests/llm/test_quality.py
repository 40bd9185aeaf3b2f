import numpy as np
import pytest
from pyspark.sql import functions as F

from goldpan.llm import quality as ql
from goldpan.llm.labelled import held_out


@pytest.fixture(scope="module")
def data(spark):
    folder = "/root/testdata/sf0.1"
    return spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")


def test_ranking_separates_a_shifted_feature():
    draw = np.random.default_rng(3)
    good = draw.random(600) < 0.8
    x = draw.normal(0, 1, (600, 18))
    x[:, 4] += 3 * ~good
    model = ql.rank(x, good, 0.7, 4000)
    scores = model(x)
    assert ((scores >= 0.7) == good).mean() > 0.9
    assert (scores >= 0.7).sum() == pytest.approx(good.sum(), abs=1)


def all_pairs(x, good):
    """Weights by the sum over every pair, one by one."""
    plain = ql.Model(x.mean(axis=0), x.std(axis=0) + 1e-6, np.zeros(36), 0, 0.7)
    z = plain.expanded(x)
    d = (z[good][:, None] - z[~good]).reshape(-1, 36)
    w = np.zeros(36)
    for _ in range(50):
        p = 1 / (1 + np.exp(d @ w))
        step = np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d / len(d) + 1e-3 * np.eye(36), d.T @ p / len(d) - 1e-3 * w)
        w = w + step / max(1, np.abs(step).max())
        if np.abs(step).max() < 1e-9:
            break
    return w


def test_every_pair_counts():
    draw = np.random.default_rng(5)
    good = draw.random(500) < 0.7
    x = np.round(draw.normal(0, 1, (500, 18)), 1) + 0.5 * good[:, None] * (np.arange(18) < 4)
    model = ql.rank(x, good, 0.7, 1_000)
    assert model.weights == pytest.approx(all_pairs(x, good), abs=1e-5)
    one = ql.rank(x[:2], np.array([True, False]), 0.7, 1)
    assert one.weights == pytest.approx(all_pairs(x[:2], np.array([True, False])), abs=1e-5)


def test_every_labelled_document_teaches(spark):
    draw = np.random.default_rng(6)
    good = np.arange(6_100) % 61 > 0
    texts = [" ".join(draw.choice(["a", "of", "word", "longer-word", "Upper!", "7"], 12, p=[0.2] * 3 + ([0.3, 0.05, 0.05] if g else [0.1, 0.15, 0.15]))) for g in good]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(g)) for i, g in enumerate(good)], "doc_id long, quality int")
    x = np.array([ql.features(t.encode()) for t in texts])
    model = ql.fit(docs, labels, F.lit(True))
    assert model.middle == pytest.approx(x.mean(axis=0))
    assert model.weights == pytest.approx(all_pairs(x, good), abs=1e-5)
    raw = np.sort(model.raw(x))
    at = int((~good).sum())
    assert model.shift + np.log(0.7 / 0.3) == pytest.approx((raw[at - 2] + raw[at - 1]) / 2)
    for given in (docs, ql.vectors(docs)):
        scored = {r.doc_id: r.score for r in ql.score(given, model).collect()}
        assert [scored[i] for i in range(len(texts))] == pytest.approx(model(x))


def test_the_cut_is_the_quantile_of_all_scores():
    draw = np.random.default_rng(7)
    x, good = np.round(draw.normal(0, 1, (200, 18))), draw.random(200) < 0.5
    model = ql.rank(x, good, 0.7, 4_000)
    raw, n = model.raw(x), (int((~good).sum()), int(good.sum()))
    order = np.lexsort((good, raw))
    for known in ((10, 31), (31, 10), (103, 5), (1, 1_000), (1_000, 1), n):
        weight = np.where(good, known[1] / n[1], known[0] / n[0])
        at = np.searchsorted(np.cumsum(weight[order]), known[0] - 1e-9)
        expected = (raw[order][max(at - 1, 0)] + raw[order][at]) / 2
        assert ql._cut(model, lambda work, ufunc=None: work(x, good), n, known) == pytest.approx(expected, abs=1e-12)
    tied = ql.rank(np.repeat(x[:20], 10, axis=0), np.repeat(good[:20], 10), 0.7, 4_000)
    assert np.abs(tied.raw(x[:20]) - tied.shift - np.log(0.7 / 0.3)).min() < 1e-9  # equal scores on both sides


def test_held_out_documents(data):
    docs, labels = data
    out = held_out(4, 2)
    scored = ql.score(docs, ql.fit(docs, labels, ~out)).join(labels, "doc_id").where(out).toPandas()
    good, found = scored["quality"] == 1, scored["score"] >= 0.7
    assert (good == found).mean() > 0.97
    assert scored["score"].between(0, 1).all()


def test_odd_and_empty(odd, empty, data):
    docs, labels = data
    silent = ql.fit(odd, labels.limit(0), F.lit(True))
    assert {round(r.score, 6) for r in ql.score(odd, silent).collect()} == {0.7}
    model = ql.fit(docs.where("doc_id < 1000"), labels, F.lit(True))
    scored = ql.score(odd, model).toPandas()
    assert scored["score"].between(0, 1).all() and len(scored) == odd.count()
    assert ql.score(empty, model).isEmpty()


def test_features_are_finite():
    for text in (b"", b" ", b"a", b"\n\n", "é😀".encode(), b"x" * 100_000):
        assert np.isfinite(ql.features(text)).all()
        assert len(ql.features(text)) == 18
