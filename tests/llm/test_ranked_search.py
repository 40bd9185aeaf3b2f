import math
import re
from collections import Counter

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from goldpan.llm import ranked_search
from goldpan.llm.oracles import llm_oracles
from goldpan.llm.queries import op12_ranked_search
from tests.llm.conftest import ODD_ROWS

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    found = TERM.findall(text or "")
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in found]


def brute_force(docs, items, k):
    """Every score of every document, by the contract."""
    counts = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    asked = {}
    for i, text in items:
        asked.setdefault(i, set()).update(terms(text))
    out = []
    for item, wanted in asked.items():
        scored = []
        for doc, c in counts:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                for t in wanted
                if c[t]
            )
            if score > 0:
                scored.append((-score, doc is None, doc or 0))
        out += [(item, r, None if none else doc, -s) for r, (s, none, doc) in enumerate(sorted(scored)[:k], start=1)]
    return sorted(out, key=repr)


def bag(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "item_id long, text string, doc_id string, score string")


def test_same_rows_as_sql(spark, tiny):
    duck = duckdb.connect()
    for name in ("documents", "benchmark"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tiny}/{name}.parquet'")
    expected = duck.execute(f"SELECT item_id, rank, doc_id, score FROM ({llm_oracles()['op12_ranked_search']})").fetchall()
    assert bag(op12_ranked_search(spark, tiny)) == sorted(expected, key=repr)


ITEMS = [
    (1, "Same words HERE, for a tie of"), (2, None), (3, "..."), (None, "null id text"), (4, "word1 AND5 word2 end"),
    (4, "größe日本語 ÀÉ naïve"), (4, "word1"), (5, "nothing-of-this-sort qqq"), (6, "a b"), (6, "a b"),
]


def test_odd_rows(spark, odd):
    docs = [(i, t) for i, t, _ in ODD_ROWS]
    for k in (2, 50):
        expected = brute_force(docs, ITEMS, k)
        assert bag(ranked_search.search(odd, items_of(spark, ITEMS), k)) == expected
        assert expected


def test_groups_of_items_change_nothing(spark, odd):
    whole = bag(ranked_search.search(odd, items_of(spark, ITEMS), 5))
    assert bag(ranked_search.search(odd, items_of(spark, ITEMS), 5, group_bytes=20)) == whole


def test_many_documents(spark, documents):
    rows = [(i, " ".join(f"w{(i * j) % 23}" for j in range(1, 2 + i % 17)), "s") for i in range(400)]
    items = [(n, " ".join(f"w{(n + j) % 23}" for j in range(5))) for n in range(12)]
    expected = brute_force([r[:2] for r in rows], items, 7)
    docs = documents(rows)
    assert bag(ranked_search.search(docs, items_of(spark, items), 7)) == expected


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 4), min_size=5, max_size=5), max_size=40), st.integers(1, 6), st.integers(0, 6), st.integers(1, 4))
def test_reads_settle_membership_ties_and_scores(impacts, k, least, depth):
    """Against all sums; lists read one to four entries at first."""
    table = np.array(impacts, np.int64).reshape(-1, 5)
    doc, term = np.nonzero(table)
    lists = ranked_search.Lists(len(table), doc, term, table[doc, term], 5)
    asked = [0, 1, 2, 4]
    before, ranked_search.FIRST_DEPTH = ranked_search.FIRST_DEPTH, depth
    try:
        found, scores = ranked_search.best(lists, asked, k, least)
    finally:
        ranked_search.FIRST_DEPTH = before
    sums = table[:, asked].sum(axis=1)
    bar = max(least, 1, sorted(sums, reverse=True)[k - 1] if len(sums) >= k else 1)
    assert dict(zip(found.tolist(), scores.tolist(), strict=True)) == {i: s for i, s in enumerate(sums.tolist()) if s >= bar}


def test_reading_ends_before_the_lists_do():
    """One document holds the top of every list: the long tails are not read."""
    n = 100_000
    doc = np.concatenate([np.arange(n), np.arange(n)])
    term = np.repeat([0, 1], n)
    impacts = np.concatenate([np.arange(n, 0, -1), np.arange(n, 0, -1)]) * 10
    lists = ranked_search.Lists(n, doc, term, impacts, 2)

    class Counted(ranked_search.Lists):
        def __init__(self):
            self.__dict__ = lists.__dict__
            self.read = 0

        def of(self, t):
            docs, values = lists.of(t)
            outer = self

            class Watched(np.ndarray):
                def __getitem__(self, key):
                    if isinstance(key, slice):
                        outer.read = max(outer.read, min(key.stop, len(self)))
                    return np.asarray(np.ndarray.__getitem__(self, key))

            return docs.view(Watched), values

    watched = Counted()
    found, scores = ranked_search.best(watched, [0, 1], 3, 1)
    assert found.tolist() == [0, 1, 2] and scores.tolist() == [20 * n, 20 * (n - 1), 20 * (n - 2)]
    assert watched.read < n / 10


def test_empty_tables(spark, empty, odd):
    assert bag(ranked_search.search(empty, items_of(spark, ITEMS))) == []
    assert bag(ranked_search.search(odd, items_of(spark, []))) == []
