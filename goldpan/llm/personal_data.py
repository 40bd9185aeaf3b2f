"""Personal data: fixed patterns, and a character BiLSTM with CRF transitions that adds to them.

The patterns (``base_spans``) give email, ip, card and phone spans and stay as they are. They also label
a bounded sample of windows, on which the network is trained in numpy. It reads windows of
``WINDOW`` characters that overlap by half; where windows overlap their scores are averaged, and
one Viterbi pass over each stretch of windows reconciles them. A span the decoder finds is added where
it touches no base span. Every kind holds a digit or an @, so the transitions into a span are barred in
windows without one: such windows decode to nothing and are not computed.

Defined results: a null or empty text has no spans; repeated rows get a row each; with no labelled
window the network stays silent; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldpan.llm.common import id_and_text, per_document

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANCHOR = re.compile(r"[0-9@]")


def _emails(text: str) -> Iterator[Span]:
    """From each @ outwards, which reads no run of letters twice."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield "email", start, done
        else:
            done = max(done, start)
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """The spans of the patterns, by kind as listed, then by start."""
    out: list[Span] = list(_emails(text)) if "@" in text else []
    if not re.search(r"[0-9]", text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = re.sub(r"[^0-9]", "", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(re.sub(r"[^0-9]", "", m.group())) <= 15:
                out.append(("phone", *m.span()))
    return out


def written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


# --- the network --------------------------------------------------------------------------------

WINDOW, STRIDE = 64, 32
CODES, WIDTH, HIDDEN = 100, 12, 16
TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind


def codes(text: str) -> np.ndarray:
    """Printable ASCII as itself, other letters as one code, the rest as another."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    ascii_ = (points >= 32) & (points < 127)
    return np.where(ascii_, points - 32, np.where(points >= 128, 96, 95))


def windows(text: str) -> list[int]:
    """Starts of the windows that hold a digit or an @."""
    hits = [m.start() for m in _ANCHOR.finditer(text)]
    last = max(0, -(-(len(text) - WINDOW) // STRIDE))
    starts = {
        k for h in hits for k in range(max(0, (h - WINDOW) // STRIDE + 1), min(last, h // STRIDE) + 1)
    }
    return [k * STRIDE for k in sorted(starts)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Network:
    """Embedding, one LSTM each way, a linear layer to tag scores, and transition scores."""

    def __init__(self, seed: int = 11):
        rng = np.random.default_rng(seed)

        def draw(*shape: int) -> np.ndarray:
            return rng.normal(0, 1 / np.sqrt(shape[0]), shape)

        self.p: dict[str, np.ndarray] = {"embed": rng.normal(0, 0.5, (CODES, WIDTH))}
        for way in ("f", "b"):
            self.p[way + "x"], self.p[way + "h"] = draw(WIDTH, 4 * HIDDEN), draw(HIDDEN, 4 * HIDDEN)
            self.p[way + "bias"] = np.repeat([0.0, 1.0, 0.0, 0.0], HIDDEN)
        self.p["out"], self.p["out_bias"] = draw(2 * HIDDEN, TAGS), np.zeros(TAGS)
        self.p["move"], self.p["first"] = np.zeros((TAGS, TAGS)), np.zeros(TAGS)

    def _lstm(self, way: str, x: np.ndarray) -> list[tuple]:
        h = c = np.zeros((x.shape[1], HIDDEN))
        steps = []
        gates_x = x @ self.p[way + "x"] + self.p[way + "bias"]
        for t in range(len(x)):
            z = gates_x[t] + h @ self.p[way + "h"]
            i, f, o = (_sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            g = np.tanh(z[:, 3 * HIDDEN :])
            before = (h, c)
            c = f * c + i * g
            tc = np.tanh(c)
            h = o * tc
            steps.append((i, f, o, g, tc, h, *before))
        return steps

    def forward(self, batch: np.ndarray) -> tuple[np.ndarray, tuple]:
        """Tag scores (time, window, tag) of windows of codes (window, time)."""
        x = self.p["embed"][batch.T]
        there, back = self._lstm("f", x), self._lstm("b", x[::-1])
        hidden = np.concatenate([np.stack([s[5] for s in there]), np.stack([s[5] for s in back])[::-1]], axis=2)
        return hidden @ self.p["out"] + self.p["out_bias"], (batch, x, there, back, hidden)

    def _lstm_back(self, way: str, x: np.ndarray, steps: list[tuple], dh_all: np.ndarray, grad: dict) -> np.ndarray:
        wx, wh = self.p[way + "x"], self.p[way + "h"]
        dh = dc = np.zeros_like(steps[0][5])
        dz_all = np.empty((len(steps), x.shape[1], 4 * HIDDEN))
        for t in range(len(steps) - 1, -1, -1):
            i, f, o, g, tc, _, _, c_before = steps[t]
            dh = dh + dh_all[t]
            dc = dc + dh * o * (1 - tc * tc)
            dz = np.concatenate(
                [dc * g * i * (1 - i), dc * c_before * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - g * g)], axis=1
            )
            dz_all[t] = dz
            dh, dc = dz @ wh.T, dc * f
        grad[way + "x"] = np.einsum("tbi,tbj->ij", x, dz_all, optimize=True)
        grad[way + "h"] = np.einsum("tbi,tbj->ij", np.stack([s[6] for s in steps]), dz_all, optimize=True)
        grad[way + "bias"] = dz_all.sum(axis=(0, 1))
        return dz_all @ wx.T

    def gradient(self, batch: np.ndarray, tags: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean negative log-likelihood of the tags (window, time), by forward and backward sums."""
        scores, (_, x, there, back, hidden) = self.forward(batch)
        steps, n = scores.shape[:2]
        move, y = self.p["move"], tags.T
        alpha = np.empty_like(scores)
        beta = np.zeros_like(scores)
        alpha[0] = self.p["first"] + scores[0]
        for t in range(1, steps):
            alpha[t] = _log_sum(alpha[t - 1][:, :, None] + move, 1) + scores[t]
        for t in range(steps - 2, -1, -1):
            beta[t] = _log_sum(move + (scores[t + 1] + beta[t + 1])[:, None, :], 2)
        total = _log_sum(alpha[-1], 1)
        d_scores = np.exp(alpha + beta - total[:, None])
        pair = alpha[:-1, :, :, None] + move + (scores[1:] + beta[1:])[:, :, None, :] - total[:, None, None]
        grad = {"move": np.exp(pair).sum(axis=(0, 1)), "first": d_scores[0].sum(axis=0)}
        np.subtract.at(grad["move"], (y[:-1], y[1:]), 1)
        np.subtract.at(grad["first"], y[0], 1)
        d_scores -= np.eye(TAGS)[y]
        grad["out"] = np.einsum("tbi,tbj->ij", hidden, d_scores, optimize=True)
        grad["out_bias"] = d_scores.sum(axis=(0, 1))
        dh = d_scores @ self.p["out"].T
        dx = self._lstm_back("f", x, there, dh[:, :, :HIDDEN], grad)
        dx = dx + self._lstm_back("b", x[::-1], back, dh[::-1, :, HIDDEN:], grad)[::-1]
        grad["embed"] = np.zeros_like(self.p["embed"])
        np.add.at(grad["embed"], batch.T, dx)
        return {k: v / n for k, v in grad.items()}

    def train(self, batch: np.ndarray, tags: np.ndarray, epochs: int = 12, size: int = 64, rate: float = 0.01, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(batch))
            for at in range(0, len(order), size):
                grad = self.gradient(batch[order[at : at + size]], tags[order[at : at + size]])
                norm = np.sqrt(sum((g * g).sum() for g in grad.values()))
                step += 1
                for k, g in grad.items():
                    g = g * min(1.0, 5 / (norm + 1e-9))
                    first[k] = 0.9 * first[k] + 0.1 * g
                    second[k] = 0.999 * second[k] + 0.001 * g * g
                    self.p[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)

    def decode(self, scores: np.ndarray) -> np.ndarray:
        """The best tags of one stretch of scores (time, tag)."""
        move = self.p["move"].copy()
        for kind in range(len(KINDS)):  # an inside tag only follows its own kind
            inside = 2 + 2 * kind
            barred = np.ones(TAGS, bool)
            barred[[inside - 1, inside]] = False
            move[barred, inside] = -1e9
        best = self.p["first"] + scores[0]
        best[2::2] = -1e9
        came = np.empty(scores.shape, np.int64)
        for t in range(1, len(scores)):
            options = best[:, None] + move
            came[t] = options.argmax(axis=0)
            best = options.max(axis=0) + scores[t]
        tags = np.empty(len(scores), np.int64)
        tags[-1] = best.argmax()
        for t in range(len(scores) - 1, 0, -1):
            tags[t - 1] = came[t][tags[t]]
        return tags

    def spans(self, text: str) -> list[Span]:
        """All spans the network finds in a whole text."""
        starts = windows(text)
        if not starts:
            return []
        known = codes(text)
        size = min(WINDOW, len(known))
        scores: dict[int, np.ndarray] = {}
        for at in range(0, len(starts), 256):
            part = starts[at : at + 256]
            batch = np.full((len(part), WINDOW), 99)
            for row, s in enumerate(part):
                piece = known[s : s + WINDOW]
                batch[row, : len(piece)] = piece
            out, _ = self.forward(batch)
            scores.update((s, out[:, row]) for row, s in enumerate(part))
        out_spans: list[Span] = []
        stretch: list[int] = []
        for s in [*starts, -1]:
            if stretch and s != stretch[-1] + STRIDE:
                begin, end = stretch[0], min(len(known), stretch[-1] + WINDOW)
                total, often = np.zeros((end - begin, TAGS)), np.zeros((end - begin, 1))
                for w in stretch:
                    n = min(WINDOW, end - w)
                    total[w - begin : w - begin + n] += scores[w][:n]
                    often[w - begin : w - begin + n] += 1
                out_spans += _from_tags(self.decode(total / often), begin)
                stretch = []
            stretch.append(s)
        return [x for x in out_spans if size and _ANCHOR.search(text, x[1], x[2])]


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def _from_tags(tags: np.ndarray, begin: int) -> list[Span]:
    out: list[list] = []
    last = 0
    for i, tag in enumerate(tags.tolist()):
        if tag:
            kind = KINDS[(tag - 1) // 2]
            if tag % 2 == 1 or not last or out[-1][0] != kind:
                out.append([kind, begin + i, begin + i + 1])
            else:
                out[-1][2] = begin + i + 1
        last = tag
    return [(k, a, b) for k, a, b in out]


def tags_of(spans: list[Span], start: int, size: int) -> np.ndarray:
    tags = np.zeros(size, np.int64)
    for kind, a, b in reversed(spans):
        lo, hi = max(a - start, 0), min(b - start, size)
        if lo < hi:
            tags[lo:hi] = 2 + 2 * KINDS.index(kind)
            if a >= start:
                tags[lo] -= 1
    return tags


# --- on tables ----------------------------------------------------------------------------------


def labelled_windows(docs: DataFrame, per_kind: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes and tags of at most ``per_kind`` windows a kind, and as many without a span.

    All texts that hold a digit or an @ are read; which windows are taken is decided by a hash.
    """
    schema = "found array<struct<kind:string,place:long,codes:binary,tags:binary>>"

    def make() -> Callable[[bytes], tuple]:
        def run(raw: bytes) -> tuple:
            text = raw.decode("utf-8", "replace")
            spans, known, out = base_spans(text), codes(text), []
            for s in windows(text):
                piece = np.full(WINDOW, 99)
                piece[: len(known[s : s + WINDOW])] = known[s : s + WINDOW]
                tags = tags_of(spans, s, WINDOW)
                kind = KINDS[(int(tags.max()) - 1) // 2] if tags.any() else ""
                out.append(
                    {"kind": kind, "place": s, "codes": piece.astype(np.uint8).tobytes(), "tags": tags.astype(np.uint8).tobytes()}
                )
            return (out,)

        return run

    likely = id_and_text(docs).filter(F.col("text").rlike("[0-9@]"))
    found = per_document(likely, schema, make).select("doc_id", F.explode("found").alias("w")).select("doc_id", "w.*")
    order = Window.partitionBy("kind").orderBy(F.xxhash64("doc_id", "place", "codes"), "codes")
    rows = (
        found.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= per_kind).orderBy("kind", "n").toPandas()
    )

    def stacked(name: str) -> np.ndarray:
        return np.array([np.frombuffer(v, np.uint8) for v in rows[name]], np.int64).reshape(-1, WINDOW)

    return stacked("codes"), stacked("tags")


def fit(docs: DataFrame, per_kind: int = 300) -> Network:
    network = Network()
    batch, tags = labelled_windows(docs, per_kind)
    if tags.any():
        network.train(batch, tags)
    else:
        network.p["out_bias"][0] = 1e3
    return network


def find(docs: DataFrame, network: Network) -> DataFrame:
    """doc_id, base and added: spans (kind, start, end) in code points."""
    sent = docs.sparkSession.sparkContext.broadcast(network)
    span = "array<struct<kind:string,start:int,end:int>>"

    def make() -> Callable[[bytes], tuple]:
        net = sent.value

        def run(raw: bytes) -> tuple:
            if not _RAW_ANCHOR.search(raw):
                return [], []
            text = raw.decode("utf-8")
            base = base_spans(text)
            taken = sorted((a, b) for _, a, b in base)
            added = [
                x for x in net.spans(text) if x[2] - x[1] >= LEAST_LENGTH and not any(a < x[2] and x[1] < b for a, b in taken)
            ]
            return _structs(base), _structs(added)

        return run

    return per_document(id_and_text(docs), f"base {span}, added {span}", make)


LEAST_LENGTH = 7  # the shortest ip
_RAW_ANCHOR = re.compile(rb"[0-9@]")


def _structs(spans: list[Span]) -> list[dict]:
    return [{"kind": k, "start": a, "end": b} for k, a, b in spans]


def report(found: DataFrame) -> DataFrame:
    """The digest columns; the counts are of base spans."""

    def listed(column: str) -> Column:
        return F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))

    def counted(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    kinds = F.array(*map(F.lit, KINDS))
    everything = F.array_sort(
        F.transform(
            F.concat("base", "added"),
            lambda s: F.struct(F.array_position(kinds, s["kind"]).alias("k"), s["start"].alias("a"), s["end"].alias("b"), s["kind"].alias("kind")),
        )
    )
    return found.select(
        "doc_id",
        *(counted(kind) for kind in KINDS),
        F.sha2(F.concat_ws(",", listed("base")), 256).alias("base_sha256"),
        F.concat_ws(
            ",", F.transform(everything, lambda s: F.concat_ws(":", s["kind"], s["a"].cast("string"), s["b"].cast("string")))
        ).alias("spans"),
    )


