"""Benchmark decontamination: Wu-Manber search for all benchmark windows at once.

The alphabet is words. Patterns of one length share a table: the last block of words under the
window decides how far the window may shift; where the shift is zero, the bucket of that suffix,
divided by the patterns' first block, names the patterns to compare word by word.

The benchmark is a stated query set. It is split by hash into blocks of about ``block_bytes`` of
text, whose size is measured first. One block, the usual case, is one pass over the documents. Of more, each is sent,
searched and taken back before the next one, so neither a broadcast nor what an executor holds grows with the benchmark;
each costs a pass over the texts, of which only rows with hits are kept, by the place of the row.

Defined results: a null or wordless text has no words and no hits; a wordless item has no window;
repeated items and rows that share an item id count as one item; a null item id is written as an
empty string; an empty benchmark finds nothing; repeated documents, and different texts under one doc_id, get a row
each; a very long text is searched whole, by one task; columns that are neither asked for nor named in ``keep`` are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldpan.llm.common import filter_texts, per_document, runs, whole_text
from goldpan.llm.exact_dedup import LOCATOR, with_locator
from goldpan.storage import fresh_path, materialize

_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_WORD_BYTE_OF = np.frombuffer(_WORD_BYTES, np.uint8)


def words(text: bytes) -> list[bytes]:
    """Lower-cased words of UTF-8 text: digits, a-z and everything beyond ASCII."""
    return text.translate(_WORD_BYTES).split()


def column_of_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of a column of texts one after the other, and how many each text has; null has none."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = _WORD_BYTE_OF[np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]]
    in_word = data != ord(" ")
    begins = in_word.copy()
    begins[1:] &= ~in_word[:-1]
    first = (offsets - offsets[0])[:-1][np.diff(offsets) > 0]
    begins[first] = in_word[first]
    at, column = runs(data, in_word, begins)
    return column, np.diff(np.searchsorted(at, offsets[1:] - offsets[0]), prepend=0)

class WuManber:
    """Patterns of one length ``m``, as word windows of items."""

    def __init__(self, m: int, windows: Iterable[tuple[str, tuple[bytes, ...]]]):
        self.m, self.b = m, min(2, m)
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.buckets: dict[tuple[bytes, ...], dict[tuple[bytes, ...], dict[tuple[bytes, ...], set[str]]]] = {}
        b = self.b
        for item, window in windows:
            for end in range(b, m + 1):
                block = window[end - b : end]
                self.shift[block] = min(self.shift.get(block, m), m - end)
            bucket = self.buckets.setdefault(window[m - b :], {})
            bucket.setdefault(window[:b], {}).setdefault(window, set()).add(item)

    def find(self, text: list[bytes]) -> Iterable[tuple[int, set[str]]]:
        """Start and items of every occurrence."""
        m, b, far = self.m, self.b, self.m - self.b + 1
        shift, end, n = self.shift, self.m, len(text)
        while end <= n:
            block = tuple(text[end - b : end])
            step = shift.get(block, far)
            if step:
                end += step
                continue
            start = end - m
            close = self.buckets[block].get(tuple(text[start : start + b]))
            if close:
                items = close.get(tuple(text[start:end]))
                if items:
                    yield start, items
            end += 1


def tables(items: Iterable[tuple[str, bytes]], window: int) -> list[WuManber]:
    """One table for each length of pattern: full windows, and whole items that are shorter."""
    by_length: dict[int, list[tuple[str, tuple[bytes, ...]]]] = {}
    for item, text in items:
        w = words(text)
        m = min(window, len(w))
        if m:
            by_length.setdefault(m, []).extend((item, tuple(w[i : i + m])) for i in range(len(w) - m + 1))
    return [WuManber(m, windows) for m, windows in sorted(by_length.items())]


def searcher(search: list[WuManber]) -> Callable[[bytes], tuple]:
    def run(text: bytes) -> tuple:
        w = words(text)
        hit: set[int] = set()
        found: set[str] = set()
        for t in search:
            for start, items in t.find(w):
                hit.update(range(start, start + t.m))
                found.update(items)
        return len(w), sorted(hit), sorted(found)

    return run


def in_blocks(benchmark: DataFrame, block_bytes: int) -> list[DataFrame]:
    """Distinct items (id as text, text) in blocks of about ``block_bytes``; one block at least."""
    asked = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), whole_text().alias("text")
    ).distinct()
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, ceil(size / block_bytes))
    return [asked.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k) for k in range(blocks)]


def send(block: DataFrame) -> Broadcast:
    """One block to the executors."""
    return block.sparkSession.sparkContext.broadcast([(r.item, r.text.encode()) for r in block.collect()])


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    block_bytes: int = 2_000_000,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """doc_id, n_words, hit (word positions), items (ids as text), and the columns in ``keep``."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"), *keep
    )
    schema = "n_words long, hit array<int>, items array<string>"
    blocks = in_blocks(benchmark, block_bytes)
    if len(blocks) == 1:
        sent = send(blocks[0])
        return per_document(rows, schema, lambda: searcher(tables(sent.value, window)), keep=keep)
    placed = with_locator(rows)
    path = fresh_path(docs.sparkSession, "hits")
    for block in blocks:
        sent = send(block)
        hits = per_document(placed, schema, lambda sent=sent: searcher(tables(sent.value, window)), keep=LOCATOR)
        hits.filter(F.size("hit") > 0).select(*LOCATOR, "hit", "items").write.mode("append").parquet(path)
        sent.unpersist()
    of_row = docs.sparkSession.read.parquet(path).groupBy(*LOCATOR).agg(
        *(F.array_distinct(F.flatten(F.collect_list(c))).alias(c) for c in ("hit", "items"))
    )
    counted = per_document(placed, "n_words long", lambda: lambda text: (len(words(text)),), keep=(*keep, *LOCATOR))
    empty = {c: F.coalesce(c, F.array().cast(kind)) for c, kind in (("hit", "array<int>"), ("items", "array<string>"))}
    return counted.join(of_row, list(LOCATOR), "left").withColumns(empty).select("doc_id", *keep, "n_words", "hit", "items")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = 2_000_000) -> DataFrame:
    """The rows without any occurrence of a window, with all their columns."""

    def without(sent: Broadcast) -> DataFrame:
        def make() -> Callable[[bytes], bool]:
            search = tables(sent.value, window)

            def clean(text: bytes) -> bool:
                found = words(text)
                return not any(True for t in search for _ in t.find(found))

            return clean

        return filter_texts(docs, make)

    *blocks, last = in_blocks(benchmark, block_bytes)
    for block in blocks:
        sent = send(block)
        docs = materialize(without(sent), "clean")
        sent.unpersist()
    return without(send(last))


def report(found: DataFrame) -> DataFrame:
    """The digest columns of a search."""
    n_hit = F.size("hit").cast("long")
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )

