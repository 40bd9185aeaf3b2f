import random
import re

import numpy as np
import pytest

from goldpan.llm import personal_data as pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def digits(text):
    return re.sub("[^0-9]", "", text)


def by_pattern(text):
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m.group())) <= 19 and pii.luhn(digits(m.group()))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m.group())) <= 15]


def test_base_spans_are_those_of_the_patterns():
    draw = random.Random(2)
    for alphabet in ("a.@@-+ (1234560..é", "0123456789-  "):
        for _ in range(20_000):
            text = "".join(draw.choice(alphabet) for _ in range(draw.randrange(40)))
            assert pii.base_spans(text) == by_pattern(text), text


def test_long_runs_take_linear_time():
    assert pii.base_spans("a" * 300_000 + " x@y " + "1" * 300_000 + "." + "2" * 300_000) == []


def test_gradient():
    net, draw = pii.Network(), np.random.default_rng(1)
    batch, tags = draw.integers(0, 99, (3, 8)), draw.integers(0, 9, (3, 8))

    def loss():
        scores, _ = net.forward(batch)
        total = 0.0
        for k in range(3):
            alpha, path = net.p["first"] + scores[0, k], net.p["first"][tags[k, 0]] + scores[0, k, tags[k, 0]]
            for t in range(1, 8):
                alpha = pii._log_sum(alpha[:, None] + net.p["move"], 0) + scores[t, k]
                path += net.p["move"][tags[k, t - 1], tags[k, t]] + scores[t, k, tags[k, t]]
            total += pii._log_sum(alpha, 0) - path
        return total / 3

    for name, grad in net.gradient(batch, tags).items():
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        value = net.p[name][at]
        net.p[name][at] = value + 1e-5
        up = loss()
        net.p[name][at] = value - 1e-5
        down = loss()
        net.p[name][at] = value
        assert grad[at] == pytest.approx((up - down) / 2e-5, rel=1e-4)


def test_windows_cover_every_digit():
    text = "x" * 500 + "7" + "y" * 90 + "@"
    for hit in (500, 591):
        assert any(s <= hit < s + pii.WINDOW for s in pii.windows(text))
    assert pii.windows("no such sign " * 50) == []


def test_learns_to_find_what_the_patterns_find(spark, documents):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    net = pii.fit(docs)
    hit = total = 0
    for r in docs.select("text").collect():
        base = {s for s in pii.base_spans(r.text) if s[0] != "card"}
        hit += len(base & set(net.spans(r.text)))
        total += len(base)
    assert hit >= 0.7 * total
    rows = [(1, "mail a.b@c.org or +1 (555) 555-1234, 10.0.0.1", "s"), (2, None, "s"), (3, "plain prose " * 30, "s")]
    found = {r.doc_id: r for r in pii.report(pii.find(documents(rows), net)).collect()}
    assert (found[1].n_email, found[1].n_phone, found[1].n_ip, found[1].n_card) == (1, 1, 1, 0)
    assert pii.written(pii.base_spans(rows[0][1])) in found[1].spans or found[1].spans.startswith("email:5:14")
    assert found[2].spans == found[3].spans == ""


def test_odd_and_empty(odd, empty):
    net = pii.fit(empty)
    assert pii.report(pii.find(empty, net)).isEmpty()
    assert pii.report(pii.find(odd, net)).count() == odd.count()
    assert net.spans("call +1 555 555 1234 now") == []
