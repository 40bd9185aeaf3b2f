import random
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from goldpan.llm import toxicity as tx
from goldpan.llm.decontaminate import column_of_words, words
from goldpan.llm.labelled import held_out, sample
from tests.llm.conftest import bag


def test_segments_against_brute_force():
    draw = random.Random(5)

    def maximal(scores):
        """Recursively: the best segment, then those to its left and right."""
        best = max(
            ((sum(scores[i:j]), -(j - i), -i, i, j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)),
            default=(0,),
        )
        if best[0] <= 0:
            return []
        i, j = best[3], best[4]
        left, right = maximal(scores[:i]), maximal(scores[j:])
        return left + [(i, j, best[0])] + [(a + j, b + j, s) for a, b, s in right]

    for _ in range(300):
        scores = [draw.choice([-7, -5, -3, -2, -1, 1, 2, 4, 6]) + draw.random() / 100 for _ in range(draw.randrange(14))]
        found = tx.segments(np.array(scores))
        assert [(a, b) for a, b, _ in found] == [(a, b) for a, b, _ in maximal(scores)], scores
        assert max([0.0, *(s for _, _, s in found)]) == pytest.approx(tx.best_sum(np.array(scores)))


TEXTS = st.lists(st.one_of(st.none(), st.text("aBé日ß. ,\n-1", max_size=30)), max_size=8)


@settings(max_examples=300, deadline=None)
@given(TEXTS, st.integers(0, 3))
def test_column_of_words_has_the_words_of_each_text(texts, skip):
    for kind in (pa.string(), pa.binary()):
        column = pa.array([t if t is None or kind == pa.string() else t.encode() for t in texts], kind)[skip:]
        found, counts = column_of_words(column)
        split = np.split(found.to_numpy(zero_copy_only=False), np.cumsum(counts)[:-1]) if len(counts) else []
        assert [list(x) for x in split] == [words((t or "").encode()) for t in texts[skip:]]


def test_a_word_is_looked_up_once_for_many_texts():
    """All occurrences in a column of texts cost one look-up, and what words share a head its beginnings once."""
    asked = []
    _, end, without = tx._places(pa.array(["bad good BAD", None, "good, bad bad ugly"] * 40), tx.Remembered(lambda w: asked.append(w) or ((3, 5) if w == b"bad" else (1,) if w == b"good" else ())))
    assert sorted(asked) == [b"bad", b"good", b"ugly"]
    assert end[:3] == [5, 5, 10] and without == [0, 0, 1] * 40


def test_scores_against_all_features():
    """A word scores as the largest of its features, with those it lacks as the rest."""
    draw = random.Random(8)
    vocabulary = ["".join(draw.choice("abé日") for _ in range(draw.randrange(1, 12))) for _ in range(400)]
    features = sorted({f for w in vocabulary[:60] for f in tx.features_of(w.encode()) if draw.random() < 0.6})
    scores = tx.Scores(np.array(features), np.array([draw.uniform(-2, 1) for _ in features]), -0.5)
    table = dict(zip(features, scores.values.tolist(), strict=True))
    texts = [" ".join(draw.choices(vocabulary, k=20)) for _ in range(30)] + [None, ""]
    for text, found in zip(texts, tx.scorer(scores)(pa.array(texts)), strict=True):
        expected = [max(table.get(f, -0.5) for f in tx.features_of(w)) for w in words((text or "").encode())]
        assert found.tolist() == expected


def test_held_out_is_the_crc(spark):
    ids = spark.range(200).select(F.col("id").alias("doc_id"), held_out(5, 0).alias("out"), held_out(4, 2).alias("two"))
    for r in ids.collect():
        assert r.out == (crc32(str(r.doc_id).encode()) % 5 == 0)
        assert r.two == (crc32(str(r.doc_id).encode()) % 4 == 2)


def test_sample_is_bounded(spark):
    labels = spark.createDataFrame([(i % 50, i % 2, None) for i in range(300)] + [(None, 1, 0)], "doc_id long, toxic int, quality int")
    chosen = sample(labels, "toxic", F.lit(True), 10)
    assert chosen.count() <= 20
    assert bag(chosen) == bag(sample(labels.orderBy(F.rand(3)), "toxic", F.lit(True), 10))
    assert sample(labels, "quality", F.lit(True), 10).isEmpty()


@pytest.fixture(scope="module")
def data(spark):
    folder = "/root/testdata/sf0.1"
    return spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")


def test_held_out_documents(data):
    docs, labels = data
    out = held_out(5, 0)
    scored = tx.score(docs, tx.fit(docs, labels, ~out)).join(labels, "doc_id").where(out).toPandas()
    toxic, found = scored["toxic"] == 1, scored["score"] >= 0.5
    assert (toxic & found).sum() >= 0.8 * toxic.sum()
    assert (found & ~toxic).sum() <= 0.03 * (~toxic).sum()
    assert (scored["score"].between(0, 1)).all()
    with_passage = scored["passages"].map(len) > 0
    assert (with_passage & toxic).sum() >= 0.6 * toxic.sum()


def test_odd_and_empty(spark, odd, empty, data):
    _, labels = data
    nothing = labels.limit(0)
    model = tx.fit(odd, nothing, F.lit(True))
    scored = {r.doc_id: r for r in tx.score(odd, model).collect()}
    assert len(scored[1].passages) == 0 and scored[1].score == scored[2].score < 0.5
    assert tx.score(odd, model).count() == odd.count()
    assert tx.score(empty, tx.fit(empty, nothing, F.lit(True))).isEmpty()
    assert tx.drop_toxic(odd, model).columns == odd.columns


def test_the_dropped_share_does_not_depend_on_the_size(data):
    docs, labels = data
    shares = []
    for part in (docs, docs.where("doc_id % 3 = 0")):
        kept = tx.drop_toxic(part, tx.fit(part, labels, F.lit(True))).count()
        shares.append(1 - kept / part.count())
    toxic = labels.where("toxic = 1").count() / labels.where("toxic is not null").count()
    assert all(abs(s - toxic) < 0.03 for s in shares), (shares, toxic)


def test_words_of_one_group_of_copies_prove_nothing():
    """Forty toxic documents of one fold share a word; ten of each fold share another."""
    folds = list(range(tx.FOLDS))
    n_all = np.array([100.0, 500.0, 1_000_000.0])
    n_toxic, n_clean = np.zeros((tx.FOLDS, 3)), np.zeros((tx.FOLDS, 3))
    n_toxic[0, 0], n_toxic[:, 1], n_toxic[:, 2], n_clean[:, 2] = 40, 10, 4_000, 40_000
    scores = tx.agreed(np.array([1, 2]), n_all, n_toxic, n_clean, folds)
    assert scores.values[0] <= scores.rest < 0 < scores.values[1]


def test_p_values_against_simulation():
    """Sums of an exponential law, a Poisson number of them: p-values are hardly ever smaller than they say."""
    draw = np.random.default_rng(6)
    model = tx.Model(tx.Scores(np.empty(0), np.empty(0), -1.0), rate=0.8, place=-1.0)
    found = []
    for _ in range(20_000):
        n = int(draw.integers(20, 400))
        count = draw.poisson(n * np.exp(0.8 * -1.0))
        found.append(model.log_p_of_all(draw.exponential(1 / 0.8, count).tolist(), n))
    for p in (0.2, 0.05, 0.01, 0.002):
        share = float(np.mean(np.array(found) <= np.log(p)))
        assert 0.1 * p < share <= 1.1 * p


def test_the_law_is_found_again():
    draw = np.random.default_rng(7)
    n = draw.integers(50, 500, 4_000)
    over = np.zeros((len(n), len(tx.GRID)))
    for i, tokens in enumerate(n):
        sums = draw.exponential(0.5, draw.poisson(tokens * 0.01))
        over[i] = (sums[:, None] > tx.GRID).sum(axis=0)
    over[:40] += 400  # a few documents that one word fills
    law = tx._law(tx.Scores(np.array([1]), np.array([2.0]), -1.0), n, over)
    # Leaving the largest out makes it a little steeper.
    assert 1.9 < law.rate < 2.8 and 0.008 < np.exp(law.rate * law.place) < 0.02


def test_dropped_are_those_that_score(data):
    docs, labels = data
    part = docs.where("doc_id < 2000")
    model = tx.fit(part, labels, F.lit(True))
    assert tx.drop_toxic(part, model).count() == tx.score(part, model).where("score < 0.5").count()


def test_moderate_passages_count_together(documents):
    """Passages none of which is significant alone make a document toxic."""
    vile = np.sort(np.array(tx.features_of(b"vile")))
    model = tx.Model(tx.Scores(vile, np.full(len(vile), 2.0), -1.0), cut=0.001)
    clean, passage = "good " * 30, "vile vile vile vile "
    rows = [(1, clean * 10 + passage, "s"), (2, (clean + passage) * 10, "s")]
    found = {r.doc_id: r for r in tx.score(documents(rows), model).collect()}
    assert found[1].score < 0.5 <= found[2].score
    assert not found[1].passages and not found[2].passages
    assert [r.doc_id for r in tx.drop_toxic(documents(rows), model).collect()] == [1]


def test_segments_of_a_long_text_take_one_pass():
    found = tx.segments(np.tile([1.0, -2.0], 200_000))
    assert len(found) == 200_000 and {b - a for a, b, _ in found} == {1}
