"""Token ids as files: frequency-ranked ids in a byte-aligned variable-length code with separate control bytes.

1. Every text is encoded once; its ids, with the end id, are written as a plain table.
2. Ids are counted over that table and ranked, the most frequent first, so that most ranks are small.
3. Documents are sorted by identifier over the whole cluster and packed into blocks of about ``block_bytes`` of ids.
4. In a block, a rank takes no byte (rank 0), one, two or four. Its two-bit length goes to a control stream, four
   to a control byte, its bytes to a data stream.

The folder holds Parquet files that any reader opens: ``blocks`` (shard, block, the number of ids before the block
in its shard, identifiers, lengths, control and data streams), ``shards`` (ids before each shard) and
``ranks`` (rank to id). A block is decoded with two table lookups by control byte and one gather for each byte of a value.

The counts that reach the driver are bounded by the vocabulary, the shard totals by the number of
partitions. One range of identifiers is one shard; a row number ends the sort key, so rows that share an
identifier, however many, still spread over shards.

Defined results: a null or empty text has the end id alone; null identifiers come first; rows that share an
identifier are ordered by a hash of their text; repeated rows are documents of their own; a very long text is
a block by itself; an empty table gives files without rows; columns not asked for are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldpan.llm.common import as_bytes, id_and_text
from goldpan.llm.encoding import Encoder, load, stretches
from goldpan.storage import fresh_path

_WIDTHS = np.array([0, 1, 2, 4], np.uint8)  # bytes of a value, by its two-bit code
_BYTE = np.arange(256)
# By control byte: the four widths it stands for.
CONTROL_WIDTHS = np.stack([_WIDTHS[(_BYTE >> (2 * i)) & 3] for i in range(4)], axis=1)

_BLOCK = (
    "shard int, block int, start long, n_ids long, doc_ids array<long>, lengths array<int>, control binary, data binary"
)


def coded(ranks: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Control and data bytes of the ranks of documents one after the other.

    A document begins at a control byte of its own; the unused places of its last one are zero, which takes no data.
    """
    quads = -(-lengths // 4)
    before = np.cumsum(quads) - quads
    padded = np.zeros(4 * int(quads.sum()), "<u4")
    first = np.cumsum(lengths) - lengths
    padded[np.arange(len(ranks)) + np.repeat(4 * before - first, lengths)] = ranks
    code = (padded > 0).astype(np.uint8) + (padded > 0xFF) + (padded > 0xFFFF)
    control = (code.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    return control, padded.view(np.uint8).reshape(-1, 4)[np.arange(4) < _WIDTHS[code][:, None]]


def decoded(control: np.ndarray, data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The ranks of documents one after the other."""
    width = CONTROL_WIDTHS[control].ravel()
    at = np.cumsum(width, dtype=np.int64) - width
    value = np.zeros(len(width), np.uint32)
    for k in range(4):
        has = np.flatnonzero(width > k)
        value[has] |= data[at[has] + k].astype(np.uint32) << np.uint32(8 * k)
    quads = -(-lengths // 4)
    first = np.cumsum(lengths) - lengths
    return value[np.arange(int(lengths.sum())) + np.repeat(4 * (np.cumsum(quads) - quads) - first, lengths)]


def _encoded(docs: DataFrame, tokenizer_path: str, end_id: int, kind: str) -> DataFrame:
    """doc_id, text_hash, ids (little-endian numbers of type ``kind``, the end id last)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = Encoder(tokenizer_path), np.array([end_id], kind).tobytes()
        for batch in batches:
            texts = as_bytes(batch.column("text"))
            for a, b in stretches(texts):
                ids = [x.astype(kind).tobytes() + end for x in encode(texts[a:b])]
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_hash"), pa.array(ids, pa.binary())], ["doc_id", "text_hash", "ids"]
                )

    rows = id_and_text(docs).select("doc_id", F.xxhash64("text").alias("text_hash"), F.encode("text", "UTF-8").alias("text"))
    return rows.mapInArrow(run, "doc_id long, text_hash long, ids binary")


def _all_ids(parts: list[bytes], kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The ids of some documents one after the other, and how many each has."""
    lengths = np.fromiter(map(len, parts), np.int64, len(parts)) // np.dtype(kind).itemsize
    return np.frombuffer(b"".join(parts), kind), lengths


def _counted(ids: DataFrame, kind: str, most: int) -> DataFrame:
    """id and n: how often each id comes, over the whole table."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(most, np.int64)
        for batch in batches:
            counts += np.bincount(_all_ids(as_bytes(batch.column("ids")), kind)[0], minlength=most)
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(counts[found])], ["id", "n"])

    return ids.select("ids").mapInArrow(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))


def _blocks(rows: DataFrame, rank_of: Broadcast, kind: str, block_bytes: int) -> DataFrame:
    """Sorted documents coded and packed into blocks, numbered within their partition, the shard."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, start, size = TaskContext.get().partitionId(), 0, 0, 0
        names: list[int | None] = []
        held: list[bytes] = []

        def pack() -> tuple[pa.RecordBatch, int]:
            ids, lengths = _all_ids(held, kind)
            control, data = coded(rank_of.value[ids], lengths)
            columns = [[shard], [block], [start], [len(ids)], [names], [lengths], [control.tobytes()], [data.tobytes()]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32())]
            row = [pa.array(c, t) for c, t in zip(columns, [*kinds, pa.binary(), pa.binary()], strict=True)]
            return pa.RecordBatch.from_arrays(row, [f.split()[0] for f in _BLOCK.split(", ")]), len(ids)

        for batch in batches:
            for name, ids in zip(batch.column("doc_id").to_pylist(), as_bytes(batch.column("ids")), strict=True):
                names.append(name)
                held.append(ids)
                size += len(ids)
                if size >= block_bytes:
                    packed, n = pack()
                    yield packed
                    block, start, size = block + 1, start + n, 0
                    names, held = [], []
        if held:
            yield pack()[0]

    return rows.select("doc_id", "ids").mapInArrow(run, _BLOCK)


def write(
    docs: DataFrame, tokenizer_path: str, end_id: int = 1, folder: str | None = None, block_bytes: int = 4_000_000
) -> str:
    """Encode all documents, write them in ascending ``doc_id`` order and return the folder."""
    spark = docs.sparkSession
    folder = folder or fresh_path(spark, "token-files")
    most = max(load(tokenizer_path).get_vocab_size(with_added_tokens=True), end_id + 1)
    kind = "<u2" if most <= 1 << 16 else "<u4"
    encoded, path = _encoded(docs, tokenizer_path, end_id, kind), fresh_path(spark, "ids")
    encoded.write.option("compression", "zstd").parquet(path)
    ids = spark.read.schema(encoded.schema).parquet(path)
    # One row for each id of the vocabulary at most.
    counts = _counted(ids, kind, most).toArrow()
    seen, n = counts["id"].to_numpy(), counts["n"].to_numpy()
    by_rank = seen[np.lexsort((seen, -n))]
    rank_of = np.zeros(most, np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank))
    ranks = [(rank, int(i)) for rank, i in enumerate(by_rank)]
    spark.createDataFrame(ranks, "rank int, id int").coalesce(1).write.parquet(f"{folder}/ranks")
    key = ["doc_id", "text_hash", "row_hash"]
    row_hash = F.xxhash64("_metadata.file_path", "_metadata.row_index").alias("row_hash")
    rows = ids.select("doc_id", "text_hash", row_hash, "ids").repartitionByRange(*key).sortWithinPartitions(*key)
    blocks = _blocks(rows, spark.sparkContext.broadcast(rank_of), kind, block_bytes)
    blocks.write.option("compression", "uncompressed").parquet(f"{folder}/blocks")
    written = spark.read.schema(_BLOCK).parquet(f"{folder}/blocks")
    totals = written.groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect()  # a row for each partition
    before = np.cumsum([0, *(r.n for r in totals)])
    starts = [(r.shard, int(b)) for r, b in zip(totals, before[:-1], strict=True)]
    spark.createDataFrame(starts, "shard int, start long").coalesce(1).write.parquet(f"{folder}/shards")
    return folder


def _binaries(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Pieces of the given sizes as a column of binaries."""
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Documents of written files: doc_id, start (ids before it), n_tokens, ids (little-endian 32-bit numbers)."""
    ranks = spark.read.schema("rank int, id int").parquet(f"{folder}/ranks").orderBy("rank").toArrow()  # the vocabulary
    shards = spark.read.schema("shard int, start long").parquet(f"{folder}/shards").collect()  # one row a partition
    sent = spark.sparkContext.broadcast((ranks["id"].to_numpy().astype("<u4"), {r.shard: r.start for r in shards}))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        id_of, before = sent.value
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                lengths = np.array(row["lengths"].as_py(), np.int64)
                streams = (np.frombuffer(row[c].as_py(), np.uint8) for c in ("control", "data"))
                ids = id_of[decoded(*streams, lengths)]
                start = before[row["shard"].as_py()] + row["start"].as_py() + np.cumsum(lengths) - lengths
                yield pa.RecordBatch.from_arrays(
                    [row["doc_ids"].values, pa.array(start), pa.array(lengths), _binaries(ids.view(np.uint8), 4 * lengths)],
                    ["doc_id", "start", "n_tokens", "ids"],
                )

    blocks = spark.read.schema(_BLOCK).parquet(f"{folder}/blocks")
    columns = ("shard", "start", "doc_ids", "lengths", "control", "data")
    return blocks.select(*columns).mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")
