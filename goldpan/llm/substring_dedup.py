"""Exact substring deduplication: bytes under a 200-byte string that also starts elsewhere go.

A document's window starts are cut into pieces by winnowing: the 200-byte window at a start picks
the smallest hash among its 32-byte grams as its anchor, and neighbouring starts with one anchor
form a piece. Equal windows pick equal anchors, so only pieces with one anchor need to meet.

1. Pieces are shuffled by anchor. A piece whose whole content came before is repeated through and
   through; contents count as equal when anchor and content agree in two 64-bit hashes.
2. Of anchors with several contents, one piece of each content is fetched. A task sorts the suffixes of
   the pieces it got with a two-stage suffix array and compares neighbours: a start that shares
   200 bytes with its neighbour is repeated. The contents of an anchor with very many do not meet:
   their windows are counted by hash, and the bytes of those that occur twice are counted in turn.
3. The repeated starts of a document are gathered, its bytes under them removed.

Periodic texts repeat pieces within the document; those are settled where they are found.

Defined results: a null text is empty; matches never cross documents; texts below 200 bytes lose
nothing; repeated rows repeat each other, so all their windows go; rows that share a null id
are told apart by their texts; an empty table gives an empty result; columns not asked for are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from goldpan.llm.common import as_bytes, id_and_text, likely_among
from goldpan.storage import materialize

LENGTH = 200
GRAM = 32
REACH = LENGTH - GRAM + 1  # grams of a window
BLOCK = 1 << 20
PER_BUCKET = 4096  # contents of an anchor that one task sorts
WINDOW_BITS = 64
_BASE = 0x9E3779B97F4A7C15
_BYTE_VALUES = np.array([xxhash.xxh64_intdigest(bytes([b])) for b in range(256)], np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    """1, base, base squared ... modulo 2**64, by doubling."""
    out = np.ones(n, np.uint64)
    filled, step = 1, base % 2**64
    while filled < n:
        take = min(filled, n - filled)
        out[filled : filled + take] = out[:take] * np.uint64(step)
        filled, step = filled + take, step * step % 2**64
    return out


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


class Winnower:
    """Cuts a block of texts into pieces: text number, first start, starts, anchor and content hashes."""

    def __init__(self):
        size = BLOCK + LENGTH + 1
        self.powers, self.inverse = _powers(_BASE, size), _powers(pow(_BASE, -1, 2**64), size)

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, ...]:
        data = np.frombuffer(b"".join(texts), np.uint8)
        n = len(data)
        ends = np.cumsum([len(t) for t in texts])
        begins = ends - [len(t) for t in texts]
        long_ = np.flatnonzero(ends - begins >= LENGTH)
        if not len(long_):
            return tuple(np.empty(0, np.int64) for _ in range(5))
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[data] * self.powers[:n], out=sums[1:])
        grams = _mixed((sums[GRAM:] - sums[: n - GRAM + 1]) * self.inverse[: n - GRAM + 1])
        # 40 bits of hash over 24 bits of place: the leftmost smallest gram wins.
        low = (grams & ~np.uint64(0xFFFFFF)) | np.arange(len(grams), dtype=np.uint64)
        width = 1
        while 2 * width <= REACH:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        rest = REACH - width
        low = np.minimum(low[: len(low) - rest], low[rest:]) if rest else low
        anchor = (low & np.uint64(0xFFFFFF)).astype(np.int64)
        counts = (ends - begins - LENGTH + 1)[long_]
        owner = np.repeat(long_, counts)
        start = np.arange(len(owner)) + np.repeat(begins[long_] - (np.cumsum(counts) - counts), counts)
        at = anchor[start]
        new = np.ones(len(start), bool)
        new[1:] = (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])
        first = np.flatnonzero(new)
        many = np.diff(np.append(first, len(start)))
        s = start[first]
        content = _mixed((sums[s + many - 1 + LENGTH] - sums[s]) * self.inverse[s] + many.astype(np.uint64))
        return owner[first], s - begins[owner[first]], many, grams[at[first]].view(np.int64), content.view(np.int64)


_PIECE = "doc_id long, text_hash long, start int, starts int, times int, anchor long, content long"


def pieces(rows: DataFrame) -> DataFrame:
    """Distinct pieces of each row, and (content null) its starts that its own pieces settle."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        winnow = Winnower()
        for batch in batches:
            texts = as_bytes(batch.column("text"))
            ids, hashes = batch.column("doc_id"), batch.column("text_hash")
            for chunk in _blocks(texts):
                yield from cut(winnow, chunk, ids, hashes)

    def cut(winnow: Winnower, chunk: list[tuple[int, int, bytes]], ids: pa.Array, hashes: pa.Array) -> Iterator[pa.RecordBatch]:
        owner, start, many, anchor, content = winnow([t for _, _, t in chunk])
        if not len(owner):
            return
        start = start + np.array([offset for _, offset, _ in chunk])[owner]
        row = np.array([i for i, _, _ in chunk])[owner]
        order = np.lexsort((start, content, anchor, row))
        r, a, c = row[order], anchor[order], content[order]
        same = np.zeros(len(r), bool)
        same[1:] = (r[1:] == r[:-1]) & (a[1:] == a[:-1]) & (c[1:] == c[:-1])
        head = np.flatnonzero(~same)
        times = np.diff(np.append(head, len(r)))
        lone = order[head]
        settled = np.sort(order[np.repeat(times > 1, times)])
        joins = np.zeros(len(settled), bool)
        joins[1:] = (row[settled][1:] == row[settled][:-1]) & (
            start[settled][1:] == start[settled][:-1] + many[settled][:-1]
        )
        runs = np.flatnonzero(~joins)
        run_starts = np.add.reduceat(many[settled], runs) if len(runs) else np.empty(0, np.int64)
        rows_out = np.concatenate([row[lone], row[settled][runs]])
        hash_out = hashes.take(pa.array(rows_out))
        none = np.ones(len(runs), bool)
        yield pa.RecordBatch.from_arrays(
            [
                ids.take(pa.array(rows_out)),
                hash_out,
                pa.array(np.concatenate([start[lone], start[settled][runs]]).astype(np.int32)),
                pa.array(np.concatenate([many[lone], run_starts]).astype(np.int32)),
                pa.array(np.concatenate([times, none]).astype(np.int32)),
                pa.array(np.concatenate([anchor[lone], hash_out.to_numpy(zero_copy_only=False)[len(lone) :]])),
                pa.array(
                    np.concatenate([content[lone], np.zeros(len(runs), np.int64)]),
                    mask=np.concatenate([np.zeros(len(lone), bool), none]),
                ),
            ],
            ["doc_id", "text_hash", "start", "starts", "times", "anchor", "content"],
        )

    return rows.select("doc_id", "text_hash", F.encode("text", "UTF-8").alias("text")).mapInArrow(run, _PIECE)


def _blocks(texts: list[bytes]) -> Iterator[list[tuple[int, int, bytes]]]:
    """Row number, offset and text, some at a time; a very long text comes in overlapping parts."""
    chunk: list[tuple[int, int, bytes]] = []
    size = 0
    for i, text in enumerate(texts):
        for offset in range(0, max(1, len(text) - LENGTH + 1), BLOCK):
            part = text[offset : offset + BLOCK + LENGTH - 1] if len(text) > BLOCK else text
            if size + len(part) > BLOCK and chunk:
                yield chunk
                chunk, size = [], 0
            chunk.append((i, offset, part))
            size += len(part)
    if chunk:
        yield chunk


def suffix_array(text: bytes, depth: int) -> list[int]:
    """Starts in the order of their suffixes, as far as the first ``depth`` bytes tell them apart.

    Two stages: suffixes smaller than their successors are sorted directly; a scan over the
    buckets of first bytes then puts every other suffix, one step left of a suffix already
    placed, at the next place of its bucket.
    """
    n = len(text)
    if n == 0:
        return []
    data = np.frombuffer(text, np.uint8)
    # An equal neighbour decides as the next unequal one does; the end is smaller than any byte.
    differs = np.flatnonzero(np.append(data[1:] != data[:-1], True))
    nearest = differs[np.searchsorted(differs, np.arange(n))]
    smaller = np.append(data[:-1] < data[1:], False)[nearest]
    direct = np.flatnonzero(smaller).tolist()
    direct.sort(key=lambda p: text[p : p + depth])
    counts = np.bincount(data, minlength=256)
    heads = (np.cumsum(counts) - counts).tolist()
    order = [-1] * n
    direct_counts = np.bincount(data[smaller], minlength=256)
    tails = np.cumsum(counts) - direct_counts
    taken = 0
    for c in np.flatnonzero(direct_counts).tolist():
        k = int(direct_counts[c])
        order[int(tails[c]) : int(tails[c]) + k] = direct[taken : taken + k]
        taken += k
    induced = (~smaller).tolist()
    order[heads[text[n - 1]]] = n - 1
    heads[text[n - 1]] += 1
    for i in range(n):
        p = order[i] - 1
        if p >= 0 and induced[p]:
            c = text[p]
            order[heads[c]] = p
            heads[c] += 1
    return order


def repeated_starts(contents: list[bytes], starts: list[np.ndarray]) -> list[np.ndarray]:
    """Of each content's starts, those whose window also begins at another start of any content."""
    text = b"\xff".join(contents) + b"\xff" * LENGTH  # no byte of UTF-8
    begins = np.cumsum([0, *(len(c) + 1 for c in contents[:-1])])
    place = np.concatenate([b + s for b, s in zip(begins, starts, strict=True)])
    asked = np.zeros(len(text), bool)
    asked[place] = True
    order = np.array(suffix_array(text, LENGTH), np.int64)
    order = order[asked[order]]
    # Common prefixes of neighbours, eight bytes at a time, while they last.
    data = np.frombuffer(text, np.uint8)
    words = np.lib.stride_tricks.sliding_window_view(data, 8)
    left, right = order[:-1], order[1:]
    alive = np.arange(len(left))
    for step in range(0, LENGTH, 8):
        alive = alive[(words[left[alive] + step] == words[right[alive] + step]).all(axis=1)]
    found = np.zeros(len(text), bool)
    found[left[alive]] = True
    found[right[alive]] = True
    return [s[found[b + s]] for b, s in zip(begins, starts, strict=True)]


def _runs(starts: np.ndarray) -> list[tuple[int, int]]:
    """Sorted starts as (first, how many) of their runs."""
    cuts = np.flatnonzero(np.diff(starts) != 1) + 1
    firsts = np.concatenate([[0], cuts])
    return [(int(starts[f]), int(n)) for f, n in zip(firsts, np.diff(np.append(firsts, len(starts))), strict=True)]


_MET = "anchor long, split boolean, doc_id long, text_hash long, start int, times int, content binary"


def _fetched(asked: DataFrame, rows: DataFrame) -> DataFrame:
    """The contents of the asked pieces."""
    per_row = asked.groupBy("id_key", "text_hash").agg(
        F.collect_list(F.struct("start", "starts", "times", "anchor", "split")).alias("asked")
    )
    found = rows.join(per_row.hint("shuffle_hash"), ["id_key", "text_hash"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = batch.column("doc_id").to_pylist(), batch.column("text_hash").to_pylist()
            for i, text in enumerate(as_bytes(batch.column("text"))):
                out = [
                    (p["anchor"], p["split"], ids[i], hashes[i], p["start"], p["times"], text[p["start"] : p["start"] + p["starts"] + LENGTH - 1])
                    for p in batch.column("asked")[i].as_py()
                ]
                if out:
                    yield _batch(out, _MET)

    cut = found.select("doc_id", "text_hash", "asked", F.encode("text", "UTF-8").alias("text"))
    return cut.mapInArrow(run, _MET)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(f.split() for f in schema.split(", ")), strict=True)
    types = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
    return pa.RecordBatch.from_arrays(
        [pa.array(c, types[k]) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], list(names)
    )


def _windows(cut: DataFrame, schema: str) -> DataFrame:
    """A row for each window of the pieces, or for those at the places in ``wanted``; ``schema`` picks the columns."""
    names = [f.split()[0] for f in schema.split(", ")]
    mask = (1 << WINDOW_BITS) - 1

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for row in batch.to_pylist():
                content = row["content"]
                wanted = row.get("wanted")
                for at in range(len(content) - LENGTH + 1) if wanted is None else wanted:
                    window = content[at : at + LENGTH]
                    row["at"], row["window"] = at, window
                    row["window_hash"] = (xxhash.xxh64_intdigest(window) & mask) - (1 << 63)
                    out.append(tuple(row[n] for n in names))
                if len(out) > 10_000:
                    yield _batch(out, schema)
                    out = []
            if out:
                yield _batch(out, schema)

    return cut.mapInArrow(run, schema)


def _counted(cut: DataFrame) -> DataFrame:
    """Repeated starts among contents of anchors with very many: no task holds the contents of an anchor.

    Windows are counted by hash, with partial counts, and what is left by their bytes; where a hash has one
    window of 200 bytes, its starts are repeated. A hash that several windows share decides nothing.
    """
    cut = cut.withColumn("id_key", F.coalesce("doc_id", F.lit(-1)))
    piece = ["id_key", "text_hash", "start"]
    places = _windows(cut, "window_hash long, id_key long, text_hash long, start int, times int, at int")
    hashes = _windows(cut.select("content"), "window_hash long")
    common = hashes.groupBy("window_hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("window_hash")
    places = materialize(places.join(common, "window_hash"), "windows")
    wanted = places.groupBy(*piece).agg(F.collect_set("at").alias("wanted"))
    held = cut.join(wanted, piece).select("content", "wanted", *piece, "times")
    exact = (
        _windows(held, "window_hash long, window binary")
        .groupBy("window_hash", "window")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    kinds = exact.groupBy("window_hash").agg(F.count(F.lit(1)).alias("kinds"))
    shared = materialize(kinds.filter("kinds > 1").select("window_hash"), "shared_hashes")
    columns = [*piece, "times", "at"]
    if shared.isEmpty():
        repeated = places.select(*columns)
    else:
        known = exact.filter("n > 1").select("window_hash", "window")
        differ = _windows(held, "window_hash long, window binary, id_key long, text_hash long, start int, times int, at int")
        differ = differ.join(shared, "window_hash", "left_semi").join(known, ["window_hash", "window"])
        repeated = places.join(shared, "window_hash", "left_anti").select(*columns).unionByName(differ.select(*columns))
    return repeated.filter("times = 1").select(
        "id_key", "text_hash", (F.col("start") + F.col("at")).alias("start"), F.lit(1).alias("starts")
    )


def _compared(met: DataFrame) -> DataFrame:
    """Repeated starts among contents that share an anchor; contents of several rows are known already."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, last = 0, None
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            for row in zip(*columns, strict=True):
                if size > BLOCK and row[0] != last:
                    yield from settle(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[6])
                last = row[0]
        yield from settle(held)

    def settle(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        if not held:
            return
        found = repeated_starts([r[6] for r in held], [np.arange(len(r[6]) - LENGTH + 1) for r in held])
        out = [
            (r[2], r[3], r[4] + first, many)
            for r, starts in zip(held, found, strict=True)
            if r[5] == 1 and len(starts)
            for first, many in _runs(starts)
        ]
        if out:
            a, b, c, d = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.int32()), pa.array(d, pa.int32())],
                ["doc_id", "text_hash", "start", "starts"],
            )

    dealt = met.repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(run, "doc_id long, text_hash long, start int, starts int")


def _without(found: DataFrame) -> DataFrame:
    """Remove the bytes under the repeated starts."""
    schema = "doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept_sha256 string"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_spans, removed, digests = [], [], []
            texts = as_bytes(batch.column("text"))
            repeated = batch.column("repeated")
            for i, text in enumerate(texts):
                spans: list[list[int]] = []
                for r in sorted((x["start"], x["starts"]) for x in repeated[i].as_py() or ()):
                    end = r[0] + r[1] - 1 + LENGTH
                    if spans and r[0] <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], end)
                    else:
                        spans.append([r[0], end])
                digest, at = sha256(), 0
                for begin, end in spans:
                    digest.update(text[at:begin])
                    at = end
                digest.update(text[at:])
                all_spans.append([{"start": b, "end": e} for b, e in spans])
                removed.append(sum(e - b for b, e in spans))
                digests.append(digest.hexdigest())
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(all_spans, span),
                    pa.array(digests, pa.string()),
                ],
                ["doc_id", "n_bytes", "n_removed", "spans", "kept_sha256"],
            )

    return found.select("doc_id", "repeated", F.encode("text", "UTF-8").alias("text")).mapInArrow(run, schema)


def remove_repeated(docs: DataFrame) -> DataFrame:
    """One row per row: doc_id, n_bytes, n_removed, spans (removed byte ranges), kept_sha256."""
    rows = id_and_text(docs).withColumn("text_hash", F.xxhash64("text"))
    by_anchor = Window.partitionBy("anchor")
    by_content = Window.partitionBy("anchor", "content")
    first = F.row_number().over(by_content.orderBy("doc_id", "text_hash", "start")) == 1
    met = (
        pieces(rows)
        .withColumns({"first": first, "times": F.sum("times").over(by_content).cast("int")})
        .withColumn("contents", F.sum(F.when(F.col("first"), 1).otherwise(0)).over(by_anchor))
        .filter("content is null or times > 1 or contents > 1")
        .withColumn("id_key", F.coalesce("doc_id", F.lit(-1)))
    )
    met = materialize(met, "pieces")
    keyed = rows.withColumn("id_key", F.coalesce("doc_id", F.lit(-1)))
    asked = met.filter("content is not null and contents > 1 and first").withColumn("split", F.col("contents") > PER_BUCKET)
    columns = ["id_key", "text_hash", "start", "starts"]
    repeated = met.filter("content is null or times > 1").select(*columns)
    many = asked.filter("split")
    if not many.isEmpty():
        # Their texts are fetched apart, so that the join below and the last one share one shuffle of all texts.
        few = likely_among(keyed, many, ["id_key", "text_hash"])
        repeated = repeated.unionByName(_counted(materialize(_fetched(many, few), "contents")))
    fetched = _fetched(asked.filter("not split"), keyed)
    compared = _compared(fetched).withColumn("id_key", F.coalesce("doc_id", F.lit(-1)))
    repeated = (
        repeated.unionByName(compared.select(*columns))
        .groupBy("id_key", "text_hash")
        .agg(F.collect_list(F.struct("start", "starts")).alias("repeated"))
    )
    return _without(keyed.join(repeated.hint("shuffle_hash"), ["id_key", "text_hash"], "left"))


def report(found: DataFrame) -> DataFrame:
    """The digest columns."""
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256"
    )
