import random
import re

from goldpan.llm import decontaminate as dc
from tests.llm.conftest import bag

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text, items):
    w = WORD.findall((text or "").encode().lower())
    hit, found = set(), set()
    for item, item_text in items:
        p = WORD.findall((item_text or "").encode().lower())
        m = min(10, len(p))
        windows = {tuple(p[i : i + m]) for i in range(len(p) - m + 1)} if m else set()
        for i in range(len(w) - m + 1):
            if m and tuple(w[i : i + m]) in windows:
                hit.update(range(i, i + m))
                found.add("" if item is None else str(item))
    return len(w), len(hit), len(found)


def test_words():
    text = "Ab-c9 É\x7fß_日本 X"
    assert dc.words(text.encode()) == WORD.findall(text.encode().lower())


def test_against_brute_force(spark, documents):
    draw = random.Random(4)
    words = ["a", "b", "c", "É", "9"]

    def text(n):
        return " ".join(draw.choice(words) for _ in range(n))

    items = [(i, text(draw.choice([1, 2, 3, 9, 10, 11, 15]))) for i in range(12)]
    items += [(None, text(10)), (3, "extra " + text(12)), (0, items[0][1]), (20, None), (21, "--")]
    rows = [(i, text(draw.randrange(0, 60)), "s") for i in range(80)]
    rows += [(100, None, "s"), (101, "x " + items[4][1] + " y", "s"), (101, "x " + items[4][1] + " y", "s"), (None, text(30), "s")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = documents(rows)
    found = dc.report(dc.decontaminate(docs, benchmark)).cache()
    got = sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items) for r in found.collect()), key=repr)
    assert got == sorted(((i, *brute(t, items)) for i, t, _ in rows), key=repr)
    assert bag(dc.report(dc.decontaminate(docs, benchmark, block_bytes=40))) == bag(found)
    clean = dc.drop_contaminated(docs, benchmark, block_bytes=40)
    assert clean.columns == docs.columns
    assert clean.count() == found.where("not contaminated").count()


def test_blocks_keep_rows_of_one_id_apart(spark, documents):
    words = [f"w{i}" for i in range(30)]
    items = [(n, " ".join(words[10 * n : 10 * n + 10])) for n in range(3)]
    texts = ["none of all these words is in any of the items", items[0][1], f"{items[1][1]} {items[2][1]} {items[0][1]}"]
    rows = [(i, t, "s") for i in (None, 7) for t in [*texts, *texts, None]]
    docs, benchmark = documents(rows), spark.createDataFrame(items, "item_id long, text string")
    expected = sorted(((i, *brute(t, items), s) for i, t, s in rows), key=repr)
    for block_bytes in (60, 10**6):
        found = dc.decontaminate(docs, benchmark, block_bytes=block_bytes, keep=("source",))
        got = [(r.doc_id, r.n_words, len(r.hit), len(r.items), r.source) for r in found.collect()]
        assert sorted(got, key=repr) == expected
        assert dc.drop_contaminated(docs, benchmark, block_bytes=block_bytes).count() == 6


def test_odd_and_empty(spark, odd, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.report(dc.decontaminate(odd, none)).where("n_hit > 0").isEmpty()
    assert dc.report(dc.decontaminate(odd, none)).count() == odd.count()
    some = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    assert dc.decontaminate(empty, some).isEmpty()
    hit = dc.report(dc.decontaminate(odd, some)).where("contaminated")
    assert [(r.doc_id, r.n_hit) for r in hit.collect()] == [(None, 6), (None, 6)]


def test_shift_skips_only_what_cannot_match():
    table = dc.tables([("i", b"a b c d e f g h i j k")], 10)[0]
    text = b"x a b c d e f g h i j k y".split()
    assert [s for s, _ in table.find(text)] == [1, 2]
    assert table.shift[(b"c", b"d")] == 6
