"""What the corpus operators share: reading tables, naming columns, batches of texts in tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

SPACE_RUN = r"[^\x20\x09-\x0D]+"
MOST_BROADCAST = 250_000  # rows of a few numbers: some 30 MB in a hash table
PER_PART = 512  # rows of a batch that are Python objects at a time
PIECE_BYTES = 1 << 22  # of texts whose words are one column
MOST_HASHES = 4_000_000  # longs: some 60 bytes each in a hash table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just ``doc_id`` and ``text``; other columns, whatever their names, stay behind."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text")
    )


def without(rows: DataFrame, gone: DataFrame, on: Column | list[str], most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """The wide ``rows`` that are not among ``gone``, a written table of narrow keys.

    Few keys are broadcast, so that no text is shuffled; beyond ``most_broadcast`` rows, counted from the
    footers, both sides are shuffled by key. The rows that stay are the same.
    """
    small = gone.count() <= most_broadcast
    return rows.join(gone.hint("broadcast" if small else "shuffle_hash"), on, "left_anti")


def likely_among(rows: DataFrame, wanted: DataFrame, on: list[str], most_hashes: int = MOST_HASHES) -> DataFrame:
    """The wide ``rows`` that share one hash of the columns ``on`` with ``wanted``, narrow and written: all that
    a join with it will find, and hardly any other, so that only their texts are shuffled.

    Up to ``most_hashes`` hashes are broadcast; beyond that, counted first, all rows are given back.
    """
    if wanted.count() > most_hashes:
        return rows
    row_hash = F.xxhash64(*on).alias("_row_hash")
    hashes = wanted.select(row_hash).distinct()
    return rows.select("*", row_hash).join(F.broadcast(hashes), "_row_hash", "left_semi").drop("_row_hash")


def per_document(
    rows: DataFrame, schema: str, make: Callable[[], Callable[[bytes], tuple]], keep: tuple[str, ...] = ()
) -> DataFrame:
    """Map each text to one row of values inside the tasks, without a shuffle.

    ``rows`` has ``doc_id`` and ``text``, and the columns in ``keep`` that pass through.
    ``make()`` runs once per task and returns a function from UTF-8 bytes to the values that
    ``schema`` (DDL of the new columns) lists.
    """

    def each() -> Callable[[pa.Array], list[tuple]]:
        work = make()
        return lambda texts: [work(t) for t in as_bytes(texts)]

    return per_column(rows, schema, each, keep, parts)


def per_column(
    rows: DataFrame,
    schema: str,
    make: Callable[[], Callable[[pa.Array], list[tuple]]],
    keep: tuple[str, ...] = (),
    cut: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]] | None = None,
) -> DataFrame:
    """As ``per_document``, but with a function from a column of texts to the rows of values; ``cut`` makes the batches smaller."""
    head = rows.select("doc_id", *keep)
    out_schema = _with_columns(head, schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in (cut or pieces)(batches):
            values = work(batch.column("text"))
            columns = [batch.column(name) for name in head_names]
            fields = [arrow.field(name) for name in head_names]
            for i, field in enumerate(list(arrow)[len(head_names) :]):
                columns.append(pa.array([v[i] for v in values], field.type))
                fields.append(field)
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(fields))

    head_names = head.columns
    arrow = to_arrow_schema(out_schema)
    return rows.select(*head_names, F.encode("text", "UTF-8").alias("text")).mapInArrow(run, out_schema)


def filter_texts(docs: DataFrame, make: Callable[[], Callable[[bytes], bool]], text_col: str = "text") -> DataFrame:
    """The rows whose text the function accepts, with all their columns, whatever their names."""

    def each() -> Callable[[pa.Array], list[bool]]:
        accepts = make()
        return lambda texts: [accepts(t) for t in as_bytes(texts)]

    return filter_column(docs, each, text_col, parts)


def filter_column(
    docs: DataFrame,
    make: Callable[[], Callable[[pa.Array], list[bool]]],
    text_col: str = "text",
    cut: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]] | None = None,
) -> DataFrame:
    """As ``filter_texts``, but with a function of a column of texts; ``cut`` makes the batches smaller."""
    place = docs.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        accepted = make()
        for batch in (cut or pieces)(batches):
            yield batch.filter(pa.array(accepted(batch.column(place)), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def _with_columns(head: DataFrame, schema: str) -> StructType:
    return StructType([*head.schema.fields, *StructType.fromDDL(schema).fields])


def parts(batches: Iterable[pa.RecordBatch], most_rows: int = PER_PART) -> Iterator[pa.RecordBatch]:
    """The batches a few rows at a time: a worker then holds the texts of so many rows as Python's bytes, not of all."""
    for batch in batches:
        for at in range(0, batch.num_rows, most_rows):
            yield batch.slice(at, most_rows)


def as_bytes(column: pa.Array) -> list[bytes]:
    """The values of a string or binary column as bytes, null as empty."""
    return [v or b"" for v in column.cast(pa.large_binary()).to_pylist()]


def pieces(batches: Iterable[pa.RecordBatch], most_bytes: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches in runs of rows of about so many bytes, by an even share of the batch; a batch of few bytes is one."""
    for batch in batches:
        rows = max(1, batch.num_rows * most_bytes // max(1, batch.nbytes))
        yield from parts([batch], rows)


def runs(data: np.ndarray, inside: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Runs of bytes ``inside``, also cut where one ``begins``, as a column of binaries; first where each begins."""
    at = np.flatnonzero(begins)
    stops = ~inside
    stops |= begins
    stops[:-1] = stops[1:].copy()
    stops[-1:] = True
    sizes = np.flatnonzero(stops & inside) + 1 - at
    offsets = np.append(0, np.cumsum(sizes)).astype(np.int32)
    return at, pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
