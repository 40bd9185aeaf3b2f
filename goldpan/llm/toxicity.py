"""Toxic passages by maximum-scoring segments of token log-odds.

A word stands for itself and for its beginnings, so that a family of words is learnt as one. Features that ``LEAST``
toxic documents of the sample hold, a larger share than of the clean ones, are candidates; they are counted by themselves over the whole corpus, and words without any
as the rest. A candidate's score is the log-odds of toxic against clean documents under a Dirichlet prior from the counts of the
whole corpus; a word scores as its most telling feature. A penalty per token makes clean text drift downwards. One linear scan over a document
finds all maximal segments with a positive sum. Under clean text the best sum of n tokens follows
an extreme-value law, S - ln(n)/lambda being Gumbel, and the number of segments above a sum is Poisson; the law is
fitted on the segments of clean labelled documents. For every r it gives the chance of r segments as large as the r best; the smallest
of these, corrected for the choice of r, is the p-value of the document, so that several moderate passages count together.
The p-value that best divides the labelled documents is the score 0.5.

The sample is dealt into folds by the smallest hash of its shingles, so that near copies mostly share a fold. A score is the
smallest of those that leave one fold out: words of one group of copies prove nothing.
Law and cut come from documents whose labels did not make the scores: each fold is scored by the counts of the others. The law leaves out the clean documents with the largest sums: a few of them, where one word
comes hundreds of times, would otherwise decide it.

Labels come from a sample bounded by ``most_per_class``, in which a text counts once however often it comes; the candidates
are bounded by the texts of its toxic half, and nothing else reaches the driver. Corpus counts come from all documents.

Defined results: a null, empty or wordless text has no segment, p-value 1 and the lowest score; a very long text is
scored whole, in one pass; without enough labels of both classes every score is that of a p-value against the
default of 0.001; labels without an id or other than 0 and 1 are not used; repeated rows get a row each; an empty
table gives an empty result; columns that are not asked for, whatever their names, are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, replace
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest as hash64

from goldpan.llm.common import as_bytes, filter_column, id_and_text, parts, per_column, pieces
from goldpan.llm.decontaminate import column_of_words, words
from goldpan.llm.labelled import sample, texts_of
from goldpan.llm.near_dedup import Shingles
from goldpan.storage import materialize

SHORTEST, LONGEST = 3, 8  # letters of beginnings; only where the word goes on
MIDDLE = 1 << 63  # hashes less this are longs
LEAST = 5
PRIOR_WORDS = 20_000.0  # strength of the corpus prior, in words
SIGNIFICANT = 0.001
ERRORS = 2.5
FOLDS = 8
PSEUDO = 20
GRID = np.arange(0.0, 32.0, 0.25)  # sums at which segments are counted
TRIMMED = 0.05  # of the clean documents, those with the largest sums
MOST_STEP = 0.5  # from the last p-value within the cut, in logs


def head_of(word: bytes) -> bytes:
    """The longest of the word's beginnings, which has the others as its own."""
    if word.isascii():
        return word[:-1][:LONGEST]
    return word.decode("utf-8", "replace")[:-1][:LONGEST].encode("utf-8", "replace")


def beginnings_of(head: bytes) -> tuple[int, ...]:
    """Hashes of the beginnings of the words with this head."""
    if head.isascii():
        return tuple([hash64(b"+" + head[:k]) - MIDDLE for k in range(SHORTEST, len(head) + 1)])
    letters = head.decode("utf-8", "replace")
    return tuple([hash64(b"+" + letters[:k].encode("utf-8", "replace")) - MIDDLE for k in range(SHORTEST, len(letters) + 1)])


def features_of(word: bytes) -> tuple[int, ...]:
    """Hashes of the word and of its beginnings."""
    return (hash64(word) - MIDDLE, *beginnings_of(head_of(word)))


class Remembered(dict):
    """A function of words whose values are kept, up to a bound."""

    def __init__(self, function: Callable[[bytes], object], most: int = 400_000):
        super().__init__()
        self.function, self.most = function, most

    def __missing__(self, word: bytes) -> object:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = self.function(word)
        return value


@dataclass
class Scores:
    """Scores of the candidates, and of every word without one."""

    features: np.ndarray
    values: np.ndarray
    rest: float


def scorer(scores: Scores) -> Callable[[pa.Array], list[np.ndarray]]:
    """Texts to the scores of their tokens: of each the largest among a word's features."""
    table, rest = dict(zip(scores.features.tolist(), scores.values.tolist(), strict=True)), scores.rest
    of_head = Remembered(lambda head: max([table.get(f, rest) for f in beginnings_of(head)], default=-np.inf))
    known = Remembered(lambda w: max(table.get(hash64(w) - MIDDLE, rest), of_head[head_of(w)]))

    def run(texts: pa.Array) -> list[np.ndarray]:
        if not len(texts):
            return []
        column, counts = column_of_words(texts)
        coded = column.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False)
        values = np.fromiter(map(known.__getitem__, distinct), np.float64, len(distinct))
        return np.split(values[coded.indices.to_numpy()], np.cumsum(counts)[:-1])

    return run


def candidates(texts: DataFrame) -> np.ndarray:
    """Features, in order, that at least ``LEAST`` toxic texts of the sample hold, and a larger share of them than of clean ones.

    Larger by a standard error at least; the scores ask for more.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = Remembered(features_of, 50_000), (Counter(), Counter())

        def rows() -> Iterator[pa.RecordBatch]:
            for label, found in enumerate(counts):  # toxic first
                counted, none = pa.array(list(found.values()), pa.int64()), pa.array([0] * len(found), pa.int64())
                columns = [pa.array(list(found), pa.int64()), none if label else counted, counted if label else none]
                yield pa.RecordBatch.from_arrays(columns, ["feature", "toxic", "clean"])
                found.clear()

        for batch in parts(batches):
            for label, text in zip(batch.column("label").to_pylist(), as_bytes(batch.column("text")), strict=True):
                counts[1 - label].update(set(chain.from_iterable(map(known.__getitem__, set(words(text))))))
                if len(counts[0]) + len(counts[1]) > 400_000:
                    yield from rows()
        yield from rows()

    of_class = dict(texts.groupBy("label").count().collect())
    counted = (
        texts.select("label", F.encode("text", "UTF-8").alias("text"))
        .mapInArrow(run, "feature long, toxic long, clean long")
        .groupBy("feature")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )
    toxic, clean = F.col("toxic") + 0.5, F.col("clean") + 0.5
    odds = F.log(toxic / of_class.get(1, 1)) - F.log(clean / of_class.get(0, 1))
    leaning = counted.filter((F.col("toxic") >= LEAST) & (odds > F.sqrt(1 / toxic + 1 / clean)))
    return np.sort(leaning.select("feature").toArrow()["feature"].to_numpy())


def _places(texts: pa.Array, known: dict[bytes, tuple[int, ...]]) -> tuple[np.ndarray, list[int], list[int]]:
    """The places of the features of all words, one text after the other; where each text's end; its distinct words without any."""
    column, counts = column_of_words(texts)
    coded = column.dictionary_encode()
    of_word = list(map(known.__getitem__, coded.dictionary.to_numpy(zero_copy_only=False)))
    size = np.fromiter(map(len, of_word), np.int64, len(of_word))
    pool, first = np.fromiter(chain.from_iterable(of_word), np.int64, int(size.sum())), np.cumsum(size) - size
    word = coded.indices.to_numpy()
    total = np.append(0, np.cumsum(size[word]))
    at = np.repeat(first[word] - total[:-1], size[word])
    at += np.arange(total[-1])
    bare = np.flatnonzero(size[word] == 0)
    text = np.repeat(np.arange(len(counts)), counts)[bare]
    once = np.unique(text * max(1, len(of_word)) + word[bare]) // max(1, len(of_word))
    return pool[at], total[np.cumsum(counts)].tolist(), np.bincount(once, minlength=len(counts)).tolist()


def feature_counts(rows: DataFrame, features: np.ndarray) -> DataFrame:
    """place, n_all, and for each fold n_clean and n_toxic: in how many documents the feature at that place is.

    ``rows`` have a text and, where they are in the sample, a label and the fold. Documents count, not
    occurrences: a word that one document repeats is no evidence beyond it. The last place counts words without a feature.
    """
    names = ["place", "n_all", *(f"{kind}_{fold}" for fold in range(FOLDS) for kind in ("n_clean", "n_toxic"))]
    sent = rows.sparkSession.sparkContext.broadcast(features)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {f: i for i, f in enumerate(sent.value.tolist())}
        of_head = Remembered(lambda head: tuple([place[f] for f in beginnings_of(head) if f in place]))

        def places(word: bytes) -> tuple[int, ...]:
            own, others = place.get(hash64(word) - MIDDLE), of_head[head_of(word)]
            return others if own is None else (own, *others)

        known = Remembered(places)
        counts = np.zeros((1 + 2 * FOLDS, len(place) + 1), np.int32)
        for batch in pieces(batches):
            found, end, rest = _places(batch.column("text"), known)
            columns = (batch.column("label").to_pylist(), batch.column("fold").to_pylist(), [0, *end[:-1]], end, rest)
            for label, fold, a, b, without in zip(*columns, strict=True):
                at = found[a:b]  # one that comes twice counts once
                for k in (0,) if label is None else (0, 1 + 2 * fold + label):
                    counts[k, at] += 1
                    counts[k, -1] += without
        seen = np.flatnonzero(counts[0])
        yield pa.RecordBatch.from_arrays([pa.array(seen), *(pa.array(c[seen].astype(np.int64)) for c in counts)], names)

    partial = rows.select("label", "fold", F.encode("text", "UTF-8").alias("text")).mapInArrow(
        run, ", ".join(f"{n} long" for n in names)
    )
    return partial.groupBy("place").agg(*(F.sum(c).alias(c) for c in names[1:]))


def log_odds(n_all: np.ndarray, n_toxic: np.ndarray, n_clean: np.ndarray) -> np.ndarray:
    """Log-odds a feature, with the corpus as prior.

    Each is drawn towards zero by ``ERRORS`` of its standard error, so a word seen in a few documents says nothing.
    """
    prior = (n_all + 0.01) / (n_all + 0.01).sum() * PRIOR_WORDS
    toxic, clean = n_toxic + prior, n_clean + prior
    odds = np.log(toxic / (toxic.sum() - toxic + 1)) - np.log(clean / (clean.sum() - clean + 1))
    return np.sign(odds) * np.maximum(np.abs(odds) - ERRORS * np.sqrt(1 / toxic + 1 / clean), 0)


def agreed(features: np.ndarray, n_all: np.ndarray, n_toxic: np.ndarray, n_clean: np.ndarray, folds: list[int]) -> Scores:
    """Scores by some of the folds (rows of the counts): the smallest that leaving one of them out gives.

    A penalty goes off, so that clean text drifts down.
    """
    kept = [[g for g in folds if g != f] for f in folds]
    odds = np.min([log_odds(n_all, n_toxic[k].sum(axis=0), n_clean[k].sum(axis=0)) for k in kept], axis=0)
    odds[-1] = 0.0  # the rest says nothing
    share = n_clean[folds].sum(axis=0) + 1e-9
    share = share / share.sum()
    mean = float((share * odds).sum())
    spread = float(np.sqrt((share * (odds - mean) ** 2).sum()))
    odds = odds - mean - 0.5 * spread - 0.05
    return Scores(features, odds[:-1], float(odds[-1]))


def best_sum(scores: np.ndarray) -> float:
    if not len(scores):
        return 0.0
    total = np.cumsum(scores)
    low = np.minimum.accumulate(np.concatenate([[0.0], total[:-1]]))
    return max(0.0, float((total - low).max()))


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, sum), in one pass with a stack of candidates."""
    at = np.flatnonzero(scores > 0)
    total = np.concatenate([[0.0], np.cumsum(scores)])
    done: list[tuple] = []
    stack: list[tuple] = []  # start, end, total before, total after, place of the last candidate that begins lower
    for i, before, after in zip(at.tolist(), total[at].tolist(), total[at + 1].tolist(), strict=True):
        start, end = i, i + 1
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= before:
                j = stack[j][4]
            if j < 0:  # nothing later can join what lies before
                done += stack
                stack = []
                break
            if stack[j][3] >= after:
                break
            start, _, before, _, _ = stack[j]
            del stack[j:]
        stack.append((start, end, before, after, j))
    return [(a, b, d - c) for a, b, c, d, _ in done + stack]


@dataclass
class Model:
    scores: Scores
    rate: float = 1.0
    place: float = 0.0
    cut: float = SIGNIFICANT

    def log_p(self, best: float, n: int) -> float:
        """Log of the chance that clean text of n tokens has a sum this large."""
        if n == 0 or best <= 0:
            return 0.0
        z = self.rate * (best - self.place) - np.log(n)
        return -z if z > 30 else float(np.log(-np.expm1(-np.exp(-max(z, -30.0)))))

    def log_p_of_all(self, sums: list[float], n: int) -> float:
        """Log of the smallest chance, over r, that clean text of n tokens has r sums as large as the r best.

        Each is corrected by 1 / (r (r + 1)), the share of r among the ways to choose it.
        """
        if not sums:
            return 0.0
        r = np.arange(1, len(sums) + 1)
        log_mean = np.log(n) - self.rate * (np.sort(sums)[::-1] - self.place)
        rare = log_mean < np.log(r)  # elsewhere r such sums are no more than expected
        r, log_mean = r[rare], log_mean[rare]
        if not len(r):
            return 0.0
        mean = np.exp(log_mean)
        factorial = np.cumsum(np.log(np.arange(1, len(sums) + 1)))[r - 1]
        # The Poisson tail by its first term and a geometric bound of the others.
        tail = r * log_mean - mean - factorial - np.log1p(-mean / (r + 1))
        return min(0.0, float((tail + np.log(r * (r + 1.0))).min()))


def _law(scores: Scores, n: np.ndarray, over: np.ndarray) -> Model:
    """The law of segments from clean documents of ``n`` tokens; ``over``: their segments above each sum of ``GRID``.

    Above a sum s, n tokens have n * K * exp(-rate * s) segments: the excess over the median sum is exponential. ``PSEUDO``
    segments with the mean positive score as their excess are added, so that a few segments give a law, too.
    """
    best = (over > 0).sum(axis=1)
    kept = best <= np.quantile(best, 1 - TRIMMED)
    tokens, total = n[kept].sum(), over[kept].sum(axis=0)
    low = int(np.flatnonzero(total >= total[0] / 2)[-1]) if total[0] else 0
    positive = scores.values[scores.values > 0]
    usual = float(positive.mean()) if len(positive) else 1.0
    excess = float((total[low] / 2 + total[low + 1 :].sum()) * (GRID[1] - GRID[0])) + PSEUDO * usual
    model = Model(scores)
    model.rate = (total[low] + PSEUDO) / excess
    model.place = float(GRID[low] + np.log((total[low] + 1) / tokens) / model.rate)
    return model


def _cut(p: np.ndarray, toxic: np.ndarray, per_toxic: float) -> float:
    """The p-value (given as logs) that best divides; ``per_toxic``: clean labels for each toxic one, among all labels."""
    order = np.argsort(p, kind="stable")
    caught = np.cumsum(toxic[order]) / toxic.sum()
    wrong = np.cumsum(~toxic[order]) / (~toxic).sum() * per_toxic
    at = int(np.argmax(caught / (1 + caught + wrong)))  # half the F1
    last = p[order][at]
    after = p[order][at + 1] if at + 1 < len(p) else 0.0
    # Towards what follows the last document within, half way in logs, but not far.
    return float(np.exp(max(-600.0, last + min((after - last) / 2, MOST_STEP))))


def _segment_counts(scores: Scores) -> Callable[[pa.Array], list[tuple]]:
    scored = scorer(scores)

    def run(texts: pa.Array) -> list[tuple]:
        rows = []
        for tokens in scored(texts):
            sums = np.array([total for _, _, total in segments(tokens)])
            rows.append((len(tokens), np.histogram(sums, [*GRID, np.inf])[0][::-1].cumsum()[::-1].tolist()))
        return rows

    return run


def _log_p(model: Model) -> Callable[[pa.Array], list[tuple]]:
    scored = scorer(model.scores)

    def run(texts: pa.Array) -> list[tuple]:
        return [(len(s), model.log_p_of_all([total for _, _, total in segments(s)], len(s))) for s in scored(texts)]

    return run


def _labelled_sample(docs: DataFrame, labels: DataFrame, learn: Column, most_per_class: int) -> DataFrame:
    """doc_id, label, fold and text, each text once: under its smallest id, with its largest label."""
    texts = texts_of(docs, sample(labels, "toxic", learn, most_per_class))
    once = texts.groupBy("text").agg(F.min("doc_id").alias("doc_id"), F.max("label").alias("label"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles()
        for batch in parts(batches):
            folds = [int(shingles(t).min(initial=2**64 - 1)) % FOLDS for t in as_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(folds, pa.int32())], ["doc_id", "label", "text", "fold"])

    dealt = once.select("doc_id", "label", "text").mapInArrow(run, "doc_id long, label int, text string, fold int")
    return materialize(dealt, "labelled")


def fit(docs: DataFrame, labels: DataFrame, learn: Column, most_per_class: int = 10_000) -> Model:
    """Counts over all documents; labels from a bounded sample of those that ``learn`` allows."""
    texts = _labelled_sample(docs, labels, learn, most_per_class)
    features = candidates(texts)
    if not len(features):
        return Model(Scores(features, np.empty(0), -0.05))
    rows = id_and_text(docs).join(F.broadcast(texts.select("doc_id", "label", "fold")), "doc_id", "left")
    counted = feature_counts(rows, features).toArrow()  # a row for each candidate, as columns
    place = counted["place"].to_numpy()

    def counts(name: str) -> np.ndarray:
        out = np.zeros(len(features) + 1)
        out[place] = counted[name].to_numpy()
        return out

    n_all = counts("n_all")
    n_toxic, n_clean = (np.array([counts(f"{kind}_{f}") for f in range(FOLDS)]) for kind in ("n_toxic", "n_clean"))

    def scores(folds: list[int]) -> Scores:
        return agreed(features, n_all, n_toxic, n_clean, folds)

    def scanned(schema: str, models: list, scan: Callable) -> pa.Table:
        """Each fold of the sample by the scores of the others."""
        scans = []
        for fold, model in enumerate(models):
            sent = docs.sparkSession.sparkContext.broadcast(model)
            mine = texts.filter(F.col("fold") == fold)
            scans.append(per_column(mine, schema, lambda sent=sent: scan(sent.value), keep=("label",)).drop("doc_id"))
        return reduce(DataFrame.unionByName, scans).filter("n > 0").toArrow()  # the sample

    whole = scores(list(range(FOLDS)))
    apart = [scores([f for f in range(FOLDS) if f != fold]) for fold in range(FOLDS)]
    found = scanned("n long, over array<long>", apart, _segment_counts)
    toxic = found["label"].to_numpy() == 1
    if (~toxic).sum() < 20 or not toxic.any():
        return Model(whole)
    over = found["over"].combine_chunks().flatten().to_numpy().reshape(-1, len(GRID))
    law = _law(whole, found["n"].to_numpy()[~toxic], over[~toxic])
    again = scanned("n long, log_p double", [replace(law, scores=s) for s in apart], _log_p)
    shares = dict(labels.filter(learn & F.col("toxic").isin(0, 1)).groupBy("toxic").count().collect())
    law.cut = _cut(
        again["log_p"].to_numpy(), again["label"].to_numpy() == 1, shares.get(0, 0) / max(1, shares.get(1, 0))
    )
    return law


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, score, and passages: word ranges with p-values, of every significant segment."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable[[pa.Array], list[tuple]]:
        m = sent.value
        scored = scorer(m.scores)

        def run(tokens: np.ndarray) -> tuple:
            found = segments(tokens)
            log_p = m.log_p_of_all([total for _, _, total in found], len(tokens))
            passages = []
            for a, b, total in found:
                p = m.log_p(total, len(tokens))
                if p < np.log(SIGNIFICANT):
                    passages.append({"start": a, "end": b, "p": float(np.exp(p))})
            log_ratio = np.clip(log_p - np.log(m.cut), -700, 700)
            return float(1 / (1 + np.exp(log_ratio))), passages

        return lambda texts: list(map(run, scored(texts)))

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *keep
    )
    schema = "score double, passages array<struct<start:int,end:int,p:double>>"
    return per_column(rows, schema, make, keep=keep)


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows that score below 0.5, with all their columns."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make() -> Callable[[pa.Array], list[bool]]:
        m = sent.value
        scored = scorer(m.scores)

        def clean(tokens: np.ndarray) -> bool:
            sums = [total for _, _, total in segments(tokens)]
            return m.log_p_of_all(sums, len(tokens)) > np.log(m.cut)

        return lambda texts: list(map(clean, scored(texts)))

    return filter_column(docs, make)
