import hashlib
import random
from collections import Counter

import pytest

from goldpan.llm import substring_dedup as sd
from tests.llm.conftest import ODD_ROWS


def brute(rows):
    texts = [(t or "").encode() for _, t, _ in rows]
    seen = Counter(t[i : i + 200] for t in texts for i in range(len(t) - 199))
    out = []
    for (doc, _, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - 199):
            if seen[t[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in sd.report(sd.remove_repeated(df)).collect()), key=repr)


def test_suffix_array():
    draw = random.Random(3)
    for _ in range(400):
        text = bytes(draw.choice(b"ab\xc3\x00z") for _ in range(draw.randrange(70)))
        assert sd.suffix_array(text, 100) == sorted(range(len(text)), key=lambda i: text[i:])


@pytest.mark.parametrize("bucket, block", [(4096, 1 << 20), (3, 900)])
def test_against_brute_force(documents, monkeypatch, bucket, block):
    """Whole copies, passages in other surroundings, periodic texts, one passage that very many hold."""
    monkeypatch.setattr(sd, "PER_BUCKET", bucket)
    monkeypatch.setattr(sd, "BLOCK", block)
    draw = random.Random(bucket)

    def prose(n):
        return "".join(draw.choice("abcdeé ") for _ in range(n))

    shared, near = prose(260), prose(230)
    rows = [(i, prose(150) + shared[: draw.randrange(180, 260)] + prose(150), "s") for i in range(30)]
    rows += [(100 + i, near if i % 2 else near[:100] + "X" + near[100:] + near, "s") for i in range(6)]
    rows += [(200, "Der " * 120, "s"), (201, "a" * 450, "s"), (202, "Der " * 49 + "De", "s"), (203, prose(199), "s")]
    rows += [(210, prose(700), "s")] * 2 + [(None, prose(420), "s")] * 2 + [(None, prose(420), "s")]
    long = prose(2500)
    rows += [(300, long + prose(50) + long[700:1400], "s"), (301, None, "s")]
    assert found(documents(rows)) == brute(rows)


def test_odd_and_empty(documents, empty):
    rows = [(i, t if len(t or "") < 5000 else t[:5000], s) for i, t, s in ODD_ROWS]
    assert found(documents(rows)) == brute(rows)
    assert found(empty) == []


@pytest.mark.parametrize("bits", [64, 4])
def test_no_task_holds_an_anchor_of_very_many_contents(documents, monkeypatch, bits):
    """What meets in one group is bounded, also where windows share a hash."""
    monkeypatch.setattr(sd, "PER_BUCKET", 8)
    monkeypatch.setattr(sd, "WINDOW_BITS", bits, raising=False)
    groups = []
    compared = sd._compared

    def watched(met):
        keys = [c for c in ("anchor", "salt") if c in met.columns]
        groups.extend(r["count"] for r in met.groupBy(*keys).count().collect())
        return compared(met)

    monkeypatch.setattr(sd, "_compared", watched)
    draw = random.Random(8)
    prose = lambda n: "".join(draw.choice("abcde ") for _ in range(n))
    shared = prose(230)
    rows = [(i, prose(120) + shared[draw.randrange(30) : 150 + draw.randrange(80)] + prose(120), "s") for i in range(60)]
    rows += [(None, rows[0][1], "s"), (70, rows[1][1], "s"), (70, rows[1][1], "s")]
    assert found(documents(rows)) == brute(rows)
    assert max(groups, default=0) <= 8


def test_contents_that_are_counted_apart_leave_one_shuffle_of_all_texts(documents, monkeypatch):
    """The fetch of the other contents is no written table, so that the last join can share its shuffle."""
    monkeypatch.setattr(sd, "PER_BUCKET", 8)
    written = []
    materialize = sd.materialize

    def watched(df, label):
        stored = materialize(df, label)
        written.append((label, stored))
        return stored

    monkeypatch.setattr(sd, "materialize", watched)
    draw = random.Random(8)
    prose = lambda n: "".join(draw.choice("abcde ") for _ in range(n))
    shared, twin = prose(230), prose(300)
    rows = [(i, prose(120) + shared[draw.randrange(30) : 150 + draw.randrange(80)] + prose(120), "s") for i in range(60)]
    rows += [(100 + i, twin + "x" * i, "s") for i in range(4)]
    assert found(documents(rows)) == brute(rows)
    contents = [stored for label, stored in written if label == "contents"]
    assert contents and all(c.filter("not split").isEmpty() for c in contents)
