"""Ranked search without random access: impact-sorted lists read in order, with score intervals (NRA).

1. One pass over the texts leaves for each document its number of terms and the frequencies of the terms
   that are asked for. Corpus counts (documents, terms, documents of a term) are taken from that.
2. A task takes the documents of its partition in blocks. A block has a list for each term, sorted by impact.
   For an item, the lists of its terms are read from the top, all as deep as each other. A document's
   lower bound is the sum of its impacts that were read; its upper bound adds the last impact read of every
   list in which it has not come up. Documents whose upper bound reaches the k-th best lower bound contend. Lists go
   on as long as a contender that has not come up in them is open, and reading ends when every contender's
   bounds meet: membership, ties and scores are then settled. The k best of earlier blocks are the
   floor of later ones.
3. A task returns k documents for each item, and those of all tasks are merged.

Scores are integers. ``weight`` and ``impact`` below are the fixed formula; any impact that is not negative would do.

The items are a stated query set. They are dealt into groups of about ``group_bytes`` of text, whose size is measured
first; a group is sent to the tasks, searched and written before the next one, so nothing sent grows with them.

Defined results: a null or termless text is no document and has no score; a very long text is one document of its block;
an item without terms has no rows; rows that share an item id are one item, with the terms of all; a null item id is
an item of its own; repeated documents get a rank each; among equal scores a null doc_id comes last; empty tables
give an empty result; columns not asked for are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from math import ceil, floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from goldpan.llm.common import as_bytes, id_and_text
from goldpan.llm.decontaminate import words
from goldpan.storage import fresh_path, materialize

BLOCK_DOCS, BLOCK_POSTINGS = 32_768, 4_000_000
FIRST_DEPTH = 1_024
MERGES = 64
_COUNTED = "doc_id long, n_terms long, terms array<int>, times array<long>"
_FOUND = "item int, doc_id long, score long"


def weight(n_docs: int, df: int) -> int:
    return floor(1000 * log((2 * n_docs + 2) / (2 * df + 1)))


def impact(w: np.ndarray, tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a term of weight ``w`` that comes ``tf`` times adds to a document of ``n`` terms."""
    m = 100 - 50 + (50 * n * n_docs) // n_terms
    return w * ((1_000_000_000 * tf) // (1000 * tf + 20 * m))


def counted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Of each document with terms: how many, and how often each term of the vocabulary comes."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = sent.value
        for batch in batches:
            kept, sizes, ends = [], [], [0]
            terms: list[int] = []
            times: list[int] = []
            for i, text in enumerate(as_bytes(batch.column("text"))):
                found = words(text)
                if not found:
                    continue
                for term, n in Counter(found).items():
                    if term in numbers:
                        terms.append(numbers[term])
                        times.append(n)
                kept.append(i)
                sizes.append(len(found))
                ends.append(len(terms))
            columns = [batch.column("doc_id").take(pa.array(kept, pa.int64())), pa.array(sizes, pa.int64())]
            columns += [
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v, kind))
                for v, kind in ((terms, pa.int32()), (times, pa.int64()))
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_terms", "terms", "times"])

    rows = id_and_text(docs).select("doc_id", F.encode("text", "UTF-8").alias("text"))
    return rows.mapInArrow(run, _COUNTED)


class Lists:
    """The postings of a block of documents: for each term its documents, the largest impact first."""

    def __init__(self, n_docs: int, doc: np.ndarray, term: np.ndarray, impacts: np.ndarray, n_terms: int):
        self.n_docs = n_docs
        order = np.lexsort((-impacts, term))
        self.doc, self.impacts = doc[order], impacts[order]
        self.begin = np.searchsorted(term[order], np.arange(n_terms + 1))

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.begin[term], self.begin[term + 1]
        return self.doc[a:b], self.impacts[a:b]


def best(lists: Lists, terms: Iterable[int], k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents of the block and their scores: all that reach ``least`` and the block's k-th best score, ties too."""
    read = [x for x in map(lists.of, terms) if len(x[0]) and x[1][0] > 0]
    lower = np.zeros(lists.n_docs, np.int64)
    unseen = np.ones((len(read), lists.n_docs), bool)
    bottom = [int(x[1][0]) for x in read]
    at = [0] * len(read)
    reading = range(len(read))
    live, depth = np.arange(lists.n_docs), FIRST_DEPTH
    while True:
        for i in reading:
            docs, impacts = read[i]
            end = at[i] + depth
            lower[docs[at[i] : end]] += impacts[at[i] : end]
            unseen[i, docs[at[i] : end]] = False
            at[i] = end
            bottom[i] = int(impacts[end - 1]) if end < len(docs) else 0
        known = lower[live]
        upper = known.copy()
        for i, most in enumerate(bottom):
            if most:
                upper += most * unseen[i, live]
        bar = max(least, 1)
        if len(known) > k:
            bar = max(bar, int(np.partition(known, len(known) - k)[len(known) - k]))
        contends = upper >= bar  # a bound that fell below never rises again, and the bar never falls
        live, is_open = live[contends], (upper > known)[contends]
        if not is_open.any():
            return live, lower[live]
        waiting = live[is_open]
        reading = [i for i, most in enumerate(bottom) if most and unseen[i, waiting].any()]
        depth *= 2


def _first(scores: np.ndarray, ids: np.ndarray, has_id: np.ndarray, k: int) -> np.ndarray:
    """Places of the k first: largest score, then smallest id, then none."""
    return np.lexsort((ids, ~has_id, -scores))[:k]


def _searched(rows: DataFrame, items: list[list[int]], weights: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast((items, weights))

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.Table]:
        held: list[pa.RecordBatch] = []
        docs = postings = 0
        for batch in batches:
            for begin in range(0, batch.num_rows, 1024):
                part = batch.slice(begin, 1024)
                held.append(part)
                docs, postings = docs + part.num_rows, postings + len(part.column("terms").flatten())
                if docs >= BLOCK_DOCS or postings >= BLOCK_POSTINGS:
                    yield pa.Table.from_batches(held)
                    held, docs, postings = [], 0, 0
        if held:
            yield pa.Table.from_batches(held)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items_, weights_ = sent.value
        nothing = np.empty(0, np.int64)
        top = [(nothing, nothing, nothing.astype(bool)) for _ in items_]
        for block in blocks(batches):
            size = block["n_terms"].to_numpy()
            term = block["terms"].combine_chunks().flatten().to_numpy()
            times = block["times"].combine_chunks().flatten().to_numpy()
            lengths = block["terms"].combine_chunks().value_lengths().to_numpy()
            doc = np.repeat(np.arange(len(size)), lengths)
            lists = Lists(len(size), doc, term, impact(weights_[term], times, size[doc], n_docs, n_terms), len(weights_))
            ids = block["doc_id"].fill_null(0).to_numpy()
            has_id = block["doc_id"].is_valid().to_numpy()
            for i, terms in enumerate(items_):
                scores, names, named = top[i]
                found, more = best(lists, terms, k, int(scores[-1]) if len(scores) == k else 1)
                scores, names = np.append(scores, more), np.append(names, ids[found])
                named = np.append(named, has_id[found])
                order = _first(scores, names, named, k)
                top[i] = scores[order], names[order], named[order]
        numbers = np.repeat(np.arange(len(top)), [len(t[0]) for t in top]).astype(np.int32)
        scores, names, named = (np.concatenate([nothing, *(t[j] for t in top)]) for j in range(3))
        yield pa.RecordBatch.from_arrays(
            [pa.array(numbers), pa.array(names, mask=named == 0), pa.array(scores)], ["item", "doc_id", "score"]
        )

    return rows.mapInArrow(run, _FOUND)


def _groups(queries: DataFrame, id_col: str, text_col: str, group_bytes: int) -> Iterator[dict[int | None, set[bytes]]]:
    """Item ids to their terms, some items at a time; one group at least."""
    asked = id_and_text(queries, id_col, text_col).distinct()
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, ceil(size / group_bytes))
    for g in range(groups):
        items: dict[int | None, set[bytes]] = {}
        for row in asked.filter(F.pmod(F.xxhash64("doc_id"), F.lit(groups)) == g).collect():  # about group_bytes
            items.setdefault(row.doc_id, set()).update(words(row.text.encode()))
        yield {i: terms for i, terms in items.items() if terms}


def search(
    docs: DataFrame,
    queries: DataFrame,
    k: int = 50,
    id_col: str = "item_id",
    text_col: str = "text",
    group_bytes: int = 4_000_000,
) -> DataFrame:
    """item_id, rank, doc_id and score of each item's k best documents."""
    spark = docs.sparkSession
    path = fresh_path(spark, "ranked")
    for items in _groups(queries, id_col, text_col, group_bytes):
        _search_group(docs, items, k).write.mode("append").parquet(path)
    return spark.read.schema("item_id long, rank int, doc_id long, score long").parquet(path)


def _search_group(docs: DataFrame, items: dict[int | None, set[bytes]], k: int) -> DataFrame:
    spark = docs.sparkSession
    names = list(items)
    vocabulary = {term: i for i, term in enumerate(sorted(set().union(*items.values())))}
    seen = Observation()
    rows = counted(docs, vocabulary).observe(seen, F.count(F.lit(1)).alias("docs"), F.sum("n_terms").alias("terms"))
    rows = materialize(rows, "frequencies")
    n_docs, n_terms = seen.get["docs"], seen.get["terms"] or 1
    # A row for each term of the group at most.
    held = rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df")).collect()
    weights = np.zeros(max(1, len(vocabulary)), np.int64)
    for row in held:
        weights[row.term] = weight(n_docs, row.df)
    terms = [sorted(vocabulary[t] for t in items[name]) for name in names]
    found = _searched(rows, terms, weights, n_docs, n_terms, k)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    # First among shares of an item's rows, so that no task meets those of all tasks.
    share = F.pmod(F.xxhash64("doc_id", "score"), F.lit(MERGES))
    for key in (["item", share], ["item"]):
        place = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
        found = found.withColumn("rank", place).filter(F.col("rank") <= k)
    known = spark.createDataFrame(list(enumerate(names)), "item int, item_id long")
    return found.join(F.broadcast(known), "item").select("item_id", "rank", "doc_id", "score")  # the group's ids
