"""What parquet footers say: rows, sizes, nulls and bounds by file and column, without reading a row.

Spark lists the files and deals them to tasks; a task opens each file, reads its footer and nothing else. Paths are those
that pyarrow opens: local, HDFS, S3 and GCS.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from decimal import Decimal
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from goldpan.sources.files import landed_files

_COLUMNS = (
    "path string, column_name string, record_count long, row_groups int, compressed_bytes long, null_count long, "
    "min_number double, max_number double, min_text string, max_text string"
)


def _opened(path: str) -> pq.ParquetFile:
    """By Spark's spelling of a path: nothing is escaped, and ``file:/`` may have one slash."""
    local = re.match(r"file:/+", path)
    if local:
        return pq.ParquetFile("/" + path[local.end() :])
    scheme, rest = re.sub(r"^s3[an]://", "s3://", path).split("://", 1)
    filesystem, name = fs.FileSystem.from_uri(f"{scheme}://{quote(rest, safe='/:@')}")
    return pq.ParquetFile(name, filesystem=filesystem)


def _bounds(found: list) -> tuple:
    """Smallest and largest, as numbers where they are numbers and as text otherwise."""
    if not found:
        return None, None, None, None
    low, high = min(f.min for f in found), max(f.max for f in found)
    if any(f.min != f.min or f.max != f.max for f in found):  # NaN, which some writers keep as a bound
        return None, None, None, None
    if isinstance(low, (int, float, Decimal)):
        return float(low), float(high), None, None
    if isinstance(low, bytes):
        return None, None, low.hex(), high.hex()
    return None, None, str(low), str(high)


def _of_file(path: str) -> Iterator[tuple]:
    with _opened(path) as file:
        footer = file.metadata
    groups = [footer.row_group(g) for g in range(footer.num_row_groups)]
    for c in range(footer.num_columns):
        chunks = [g.column(c) for g in groups]
        known = [k.statistics for k in chunks]
        nulls = None
        if all(s is not None and s.has_null_count for s in known):
            nulls = sum(s.null_count for s in known)
        # A row group of nulls has no bounds and needs none; one with values and without bounds hides the file's.
        bounded = [s for s in known if s is not None and s.has_min_max]
        hidden = any(
            s is None or (not s.has_min_max and not (s.has_null_count and s.null_count == k.num_values))
            for s, k in zip(known, chunks, strict=True)
        )
        yield (
            path,
            footer.schema.column(c).path,
            footer.num_rows,
            footer.num_row_groups,
            sum(k.total_compressed_size for k in chunks),
            nulls,
            *_bounds([] if hidden else bounded),
        )


def file_statistics(spark: SparkSession, folder: str, pattern: str = "*.parquet", files_per_task: int = 200) -> DataFrame:
    """One row per file and column of the parquet under ``folder``.

    ``null_count`` is null, and so are the bounds, where the writer kept none for a row group with values. Numbers
    have ``min_number`` and ``max_number``, all else text; nested columns have dotted names.
    """
    schema = StructType.fromDDL(_COLUMNS)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows = list(_of_file(path))
                columns = zip(*rows, strict=True) if rows else [[] for _ in arrow]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow
                )

    paths = landed_files(spark, folder, pattern).select("path")
    tasks = max(1, -(-len(paths.inputFiles()) // files_per_task))
    return paths.repartition(tasks, "path").mapInArrow(run, schema)


def table_statistics(files: DataFrame) -> DataFrame:
    """Rows, nulls and bounds by column over all files; null where some file with rows does not tell."""

    def whole(value: str, combine) -> F.Column:
        return combine(value).alias(value)

    told = F.count_if(
        F.coalesce("min_number", F.lit(None).cast("double")).isNull()
        & F.col("min_text").isNull()
        & (F.col("record_count") > F.coalesce("null_count", F.lit(0)))
    )
    unknown_nulls = F.count_if(F.col("null_count").isNull())
    return (
        files.groupBy("column_name")
        .agg(
            F.sum("record_count").alias("record_count"),
            F.sum("compressed_bytes").alias("compressed_bytes"),
            F.when(unknown_nulls == 0, F.sum("null_count")).alias("null_count"),
            told.alias("untold"),
            whole("min_number", F.min),
            whole("max_number", F.max),
            whole("min_text", F.min),
            whole("max_text", F.max),
        )
        .select(
            "column_name",
            "record_count",
            "compressed_bytes",
            "null_count",
            *(F.when(F.col("untold") == 0, F.col(c)).alias(c) for c in ("min_number", "max_number", "min_text", "max_text")),
        )
    )
