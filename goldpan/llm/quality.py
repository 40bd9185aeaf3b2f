"""Document quality by pairwise ranking (Bradley-Terry).

A document is a vector of counts and ratios of its whole text. Every labelled document that may teach does, and every
pair of a good one and a poor one is a preference; the weights maximise the likelihood of all preferences, which is
logistic loss on differences of vectors. The score is the weighted sum through a logistic
curve, shifted so that the quantile of labelled scores that matches the share of poor ones falls on the threshold.

All pairs at the cost of the rows: a pair counts by the difference of two scores alone, so the rows are
spread over a grid of scores, the pairs of grid points are summed on the driver, and each row reads its sum from the grid again.
With cubic weights on steps of ``FINE`` that is the sum over all pairs to some 1e-7 of a pair. Vectors are stored; tasks send
sums only, of a size that does not grow with the rows.

Defined results: a null, empty or wordless text has a vector like any other (all zeros) and gets its
score; without labels of both classes every score is the threshold; repeated rows get a row
each and teach as often; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldpan.llm.common import id_and_text, per_document
from goldpan.llm.labelled import labelled
from goldpan.storage import materialize

FEATURES = 18
RIDGE = 1e-3
FINE, COARSE = 1 / 16, 1 / 4  # steps of the grids of scores, for the gradient and for the steps of the search
_UPPER = bytes(range(65, 91))
_MARKS = bytes(b for b in range(33, 127) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122) and b not in b".,'-")


def features(text: bytes) -> list[float]:
    """Ratios that do not depend on the language, of one whole text."""
    words = text.split()
    n, size = max(1, len(words)), max(1, len(text))
    lines = text.split(b"\n")
    often = Counter(words)
    most = often.most_common(1)[0][1] if often else 0
    pairs = len(set(zip(words, words[1:], strict=False)))
    letters = size - sum(map(text.count, (b" ", b"\n")))
    upper = len(text) - len(text.translate(None, _UPPER))
    marks = len(text) - len(text.translate(None, _MARKS))
    return [
        np.log1p(len(words)),
        letters / n / 10,
        upper / size,
        upper / n,
        marks / size,
        marks / n,
        text.count(b"|") / n,
        text.count(b"!") / n,
        text.count(b".") / n,
        text.count(b",") / n,
        (len(text) - len(text.translate(None, b"0123456789"))) / size,
        len(often) / n,
        most / n,
        pairs / n,
        len(set(lines)) / len(lines),
        len(lines) / n,
        sum(1 for w in often if len(w) > 12) / n,
        sum(c for w, c in often.items() if len(w) <= 3) / n,
    ]


def _vector(text: bytes) -> tuple:
    return (features(text),)


@dataclass
class Model:
    middle: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    shift: float
    threshold: float

    def expanded(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.middle) / self.spread, -4, 4)
        return np.concatenate([z, z * z], axis=-1)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x) - self.shift, -700, 700)))

    def raw(self, x: np.ndarray) -> np.ndarray:
        """The weighted sums, each the same whatever rows stand beside it."""
        return (self.expanded(x) * self.weights).sum(axis=-1)


# Sums, or what else the ufunc gives, of an array that a function makes of rows: their vectors, and which are good.
Work = Callable[[np.ndarray, np.ndarray], np.ndarray]
Reduced = Callable[..., np.ndarray]


def _cubic(raw: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The first of the four grid points around each score, and their weights: Lagrange's, exact for cubic functions."""
    at = np.floor(raw / FINE)
    t = raw / FINE - at
    weights = [-t * (t - 1) * (t - 2) / 6, (t + 1) * (t - 1) * (t - 2) / 2, -(t + 1) * t * (t - 2) / 2, (t + 1) * t * (t - 1) / 6]
    return at.astype(np.int64) - 1, weights


def _linear(raw: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The first of the two grid points around each score, and their weights, none below zero."""
    at = np.floor(raw / COARSE)
    t = raw / COARSE - at
    return at.astype(np.int64), [1 - t, t]


def _spread(first: np.ndarray, weights: list[np.ndarray], size: int) -> np.ndarray:
    return sum(np.bincount(first + i, w, minlength=size) for i, w in enumerate(weights))


def _over_pairs(kernel: Callable[[np.ndarray], np.ndarray], step: float, rows: int, values: np.ndarray, pairs: int) -> np.ndarray:
    """For each of ``rows`` grid points a the sum over b of kernel(score a - score b) * values[b], at most ``pairs`` pairs at a time."""
    at = np.arange(len(values))
    width = max(1, pairs // max(1, len(values)))
    blocks = [np.arange(i, min(i + width, rows)) for i in range(0, rows, width)]
    return np.concatenate([kernel((block[:, None] - at) * step) @ values for block in blocks])


def _wrong(d: np.ndarray) -> np.ndarray:
    """Chance given to the wrong order of two rows whose scores differ by d."""
    return 1 / (1 + np.exp(np.clip(d, -700, 700)))


def _bend(d: np.ndarray) -> np.ndarray:
    p = _wrong(np.abs(d))
    return p * (1 - p)


def _pair_sums(model: Model, reduced: Reduced, n: tuple[int, int], pairs: int) -> tuple[float, Callable]:
    """Loss over all pairs at the model's weights, and a function that gives its gradient and Hessian."""
    reach = np.abs(model.weights).reshape(2, -1).sum(axis=1) @ [4, 16]  # no score is larger
    fine, coarse = int(reach / FINE) + 4, int(reach / COARSE) + 2  # places of the score 0
    sizes = 2 * fine + 4, 2 * coarse + 4

    def histograms(x: np.ndarray, good: np.ndarray) -> np.ndarray:
        out = []
        for raw in (model.raw(x[~good]), model.raw(x[good])):
            for (first, weights), zero, size in ((_cubic(raw), fine, sizes[0]), (_linear(raw), coarse, sizes[1])):
                out.append(_spread(first + zero, weights, size))
        return np.concatenate(out)

    poor_fine, poor_coarse, good_fine, good_coarse = np.split(reduced(histograms), np.cumsum([*sizes, sizes[0]]))
    # The points in use, and those that a row on a point reads with a weight of zero.
    used = np.flatnonzero((poor_fine != 0) | (good_fine != 0))
    low, high = used[0] - 2, used[-1] + 3
    poor_fine, good_fine = poor_fine[low:high], good_fine[low:high]
    used = np.flatnonzero(poor_coarse + good_coarse)
    low_coarse, high_coarse = used[0] - 1, used[-1] + 2
    poor_coarse, good_coarse = poor_coarse[low_coarse:high_coarse], good_coarse[low_coarse:high_coarse]
    all_pairs = n[0] * n[1]
    loss = good_fine @ _over_pairs(lambda d: np.logaddexp(0, -d), FINE, high - low, poor_fine, pairs) / all_pairs
    loss += RIDGE / 2 * model.weights @ model.weights

    def derivatives() -> tuple[np.ndarray, np.ndarray]:
        pulls = [  # of a poor row down, of a good row up
            _over_pairs(lambda d: -_wrong(-d), FINE, high - low, good_fine, pairs) / all_pairs,
            _over_pairs(_wrong, FINE, high - low, poor_fine, pairs) / all_pairs,
        ]
        points = high_coarse - low_coarse
        bends = [_over_pairs(_bend, COARSE, points, h, pairs) / all_pairs for h in (good_coarse, poor_coarse)]
        width = len(model.weights)

        def sums(x: np.ndarray, good: np.ndarray) -> np.ndarray:
            gradient, own, sides = np.zeros(width), np.zeros((width, width)), []
            for rows, pull, bend in zip((x[~good], x[good]), pulls, bends, strict=True):
                z, raw = model.expanded(rows), model.raw(rows)
                first, weights = _cubic(raw)
                first += fine - low
                gradient += sum(w * pull[first + i] for i, w in enumerate(weights)) @ z
                first, weights = _linear(raw)
                first += coarse - low_coarse
                own += (z * sum(w * bend[first + i] for i, w in enumerate(weights))[:, None]).T @ z
                side = np.zeros((points, width))
                for i, w in enumerate(weights):
                    np.add.at(side, first + i, z * w[:, None])
                sides.append(side.ravel())
            return np.concatenate([gradient, own.ravel(), *sides])

        found = reduced(sums)
        gradient, own, sides = np.split(found, [width, width + width * width])
        poor, good = sides.reshape(2, points, width)
        mixed = good.T @ _over_pairs(_bend, COARSE, points, poor, pairs) / all_pairs
        hessian = own.reshape(width, width) - mixed - mixed.T + RIDGE * np.eye(width)
        return gradient - RIDGE * model.weights, hessian

    return float(loss), derivatives


def _ordered(raw: np.ndarray) -> np.ndarray:
    """Unsigned numbers in the order of the doubles."""
    bits = (raw + 0.0).view(np.uint64)
    top = np.uint64(1 << 63)
    return np.where(bits & top, ~bits, bits | top)


def _double(key: int) -> float:
    bits = key ^ (1 << 63) if key >> 63 else key ^ ((1 << 64) - 1)
    return float(np.array([bits], np.uint64).view(float)[0])


def _cut(model: Model, reduced: Reduced, n: tuple[int, int], known: tuple[int, int]) -> float:
    """Between the score at which the smallest ones reach the share of poor ones and the one before it; a class weighs as much
    as it has labels."""
    weights = known[0] * n[1], known[1] * n[0]
    target = known[0] * n[0] * n[1]
    prefix, below = 0, 0
    for shift in (48, 32, 16, 0):  # of the number of that score, 16 bits a pass

        def digits(x: np.ndarray, good: np.ndarray, shift: int = shift, prefix: int = prefix) -> np.ndarray:
            keys = _ordered(model.raw(x))
            inside = np.ones(len(keys), bool) if shift == 48 else keys >> np.uint64(shift + 16) == np.uint64(prefix)
            digit = ((keys >> np.uint64(shift)) & np.uint64(0xFFFF)).astype(np.int64)
            return np.concatenate([np.bincount(digit[inside & c], minlength=1 << 16) for c in (~good, good)]).astype(float)

        poor, good = reduced(digits).reshape(2, -1).astype(int).tolist()
        weight = [p * weights[0] + g * weights[1] for p, g in zip(poor, good, strict=True)]
        digit = next(i for i, total in enumerate(accumulate(weight)) if below + total >= target)
        prefix, below = prefix << 16 | digit, below + sum(weight[:digit])
    high = _double(prefix)
    if below + weights[0 if poor[digit] else 1] < target:
        return high  # the one before is equal

    def largest_below(x: np.ndarray, good: np.ndarray) -> np.ndarray:
        raw = model.raw(x)
        return np.array([np.max(raw, initial=-np.inf, where=raw < high)])

    low = reduced(largest_below, np.maximum)[0]
    return (low + high) / 2 if np.isfinite(low) else high


def _rank(reduced: Reduced, threshold: float, pairs: int, known: tuple[int, int] | None = None) -> Model:
    """Weights from all pairs: ridge-regularised Newton steps on the Bradley-Terry likelihood, halved where they go too far."""
    sums = reduced(lambda x, good: np.array([(~good).sum(), good.sum(), *x.sum(axis=0)], float))
    n = int(sums[0]), int(sums[1])
    middle = sums[2:] / max(1, sum(n))
    squares = reduced(lambda x, good: ((x - middle) ** 2).sum(axis=0))
    spread = np.sqrt(squares / max(1, sum(n))) + 1e-6
    level = np.log(threshold / (1 - threshold))
    model = Model(middle, spread, np.zeros(2 * FEATURES), -level, threshold)
    if not all(n):
        return model
    best, start, step = np.inf, model.weights, np.zeros(2 * FEATURES)
    for _ in range(100):
        model.weights = start + step
        loss, derivatives = _pair_sums(model, reduced, n, pairs)
        if loss > best + 1e-7:
            step = step / 2
            continue
        best, start = loss, model.weights
        step = np.linalg.solve(*derivatives()[::-1])
        step = step / max(1.0, np.abs(step).max())
        if np.abs(step).max() < 1e-6:
            break
    model.weights = start
    model.shift = float(_cut(model, reduced, n, known or n) - level)
    return model


def rank(x: np.ndarray, good: np.ndarray, threshold: float, pairs: int) -> Model:
    """Weights from all pairs of rows in memory; ``pairs`` bounds the pairs of grid points that are computed at a time."""
    return _rank(lambda work, ufunc=np.add: work(x, good), threshold, pairs)


@dataclass(frozen=True)
class Vectors:
    """``doc_id`` and the vector ``x`` of each row, for ``fit`` and ``score`` to share."""

    rows: DataFrame


def _vectors(docs: DataFrame) -> Vectors:
    return Vectors(per_document(id_and_text(docs), "x array<double>", lambda: _vector))


def vectors(docs: DataFrame) -> Vectors:
    """The vectors of all rows, stored, so that each text is read once."""
    return Vectors(materialize(_vectors(docs).rows, "quality_vectors"))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, FEATURES)


def _in_tasks(rows: DataFrame) -> Reduced:
    """Reduces rows of ``label`` and ``x`` in the tasks, to one array each."""

    def reduced(work: Work, ufunc: np.ufunc = np.add) -> np.ndarray:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                part = work(_matrix(batch), batch.column("label").to_numpy(zero_copy_only=False) == 1)
                total = part if total is None else ufunc(total, part)
            if total is not None:
                yield pa.RecordBatch.from_pydict({"part": [zlib.compress(total.tobytes(), 1)]})

        total = None
        for row in rows.mapInArrow(run, "part binary").collect():
            part = np.frombuffer(zlib.decompress(row.part))
            total = part if total is None else ufunc(total, part)
        return total

    return reduced


def fit(docs: DataFrame | Vectors, labels: DataFrame, learn: Column, threshold: float = 0.7, pairs: int = 40_000) -> Model:
    """Weights from all rows whose label may teach; ``pairs`` as in ``rank``."""
    rows = (docs if isinstance(docs, Vectors) else vectors(docs)).rows
    taught = materialize(rows.join(labelled(labels, "quality", learn), "doc_id").select("label", "x"), "quality_labelled")
    if taught.isEmpty():
        return rank(np.zeros((0, FEATURES)), np.zeros(0, bool), threshold, pairs)
    # Labels may repeat or have no document; the quantile needs the share in all of them.
    counts = dict(
        labels.filter(learn & F.col("quality").isin(0, 1)).groupBy("quality").count().collect()
    )
    return _rank(_in_tasks(taught), threshold, pairs, (counts.get(0, 0), counts.get(1, 0)))


def score(docs: DataFrame | Vectors, model: Model) -> DataFrame:
    """doc_id and score."""
    rows = (docs if isinstance(docs, Vectors) else _vectors(docs)).rows
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(sent.value(_matrix(batch)), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), scores], ["doc_id", "score"])

    return rows.mapInArrow(run, "doc_id long, score double")
