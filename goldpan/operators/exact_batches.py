"""Test batches by row position: contiguous, of equal length, with exact numbers of issues.

A position is the number of rows before a row, files in the order of their paths. Files are counted and the counts
summed along the list of files, so no task orders the rows.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldpan.operators import issues
from goldpan.schema import RAW_COLUMNS
from goldpan.sources.csv_batches import FOLDER_NAME, write_batches
from goldpan.storage import materialize

# Draws are below 2^31; that many of them share a step of the first count.
_STEP_BITS = 16


def _placed(df: DataFrame) -> DataFrame | None:
    """The rows with their file and row number; None if the frame is more than a scan of files."""
    try:
        placed = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    except AnalysisException:
        return None
    by_file = placed.groupBy("_file").agg(F.count("*").alias("n"), F.max("_row").alias("last"))
    return placed if by_file.where("n != last + 1").isEmpty() else None


def with_position(df: DataFrame) -> tuple[DataFrame, int]:
    """The rows with their ``position`` from 0 on, and how many there are.

    A frame that is not a plain scan is written first: filters and joins leave gaps in the row numbers.
    """
    placed = _placed(df)
    if placed is None:
        placed = _placed(materialize(df, "rows"))
    counts = placed.groupBy("_file").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    files = materialize(counts.select("_file", "n", before.alias("_before")), "file-offsets")  # a row for each file
    total = files.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    numbered = placed.join(files.drop("n"), "_file").withColumn("position", F.col("_before") + F.col("_row"))
    return numbered.drop("_file", "_row", "_before"), total


def batch_sizes(total: int, num_batches: int) -> list[int]:
    """Equal parts; what does not divide goes to the last."""
    size = total // num_batches
    return [size] * (num_batches - 1) + [total - size * (num_batches - 1)]


def split_contiguous(df: DataFrame, num_batches: int = 3) -> tuple[DataFrame, list[int]]:
    """The rows with ``position`` and ``batch_no``, and the sizes of the batches."""
    numbered, total = with_position(df)
    size = total // num_batches
    number = F.least(F.floor(F.col("position") / size), F.lit(num_batches - 1)) + 1 if size else F.lit(num_batches)
    return numbered.withColumn("batch_no", number.cast("int")), batch_sizes(total, num_batches)


def scrambled(position: Column) -> Column:
    """A permutation of the positions below 2^31 - 2: the fifth power modulo a prime."""
    prime = issues.PRIME
    x = position % (prime - 1) + 1
    square = x * x % prime
    return square * square % prime * x % prime


def first_draws(rows: DataFrame, draw: Column, wanted: list[int]) -> list[tuple[int, int]]:
    """For each batch the draw and position of the row that is the ``wanted``-th by draw, then position.

    Draws are counted in steps first, then the rows of one step a batch are ordered. (-1, -1) where none is wanted.
    """
    drawn = rows.select("batch_no", draw.alias("draw"), "position")
    ask = F.element_at(F.array(*map(F.lit, wanted)), F.col("batch_no"))
    step = F.shiftright("draw", _STEP_BITS)
    counts = drawn.groupBy("batch_no", step.alias("step")).agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy("batch_no").orderBy("step"))
    edges = (
        counts.withColumn("upto", upto)
        .where((F.col("upto") - F.col("n") < ask) & (ask <= F.col("upto")))
        .select("batch_no", "step", (F.col("upto") - F.col("n")).alias("before"))
        .collect()  # a row for each batch
    )
    found = [(-1, -1)] * len(wanted)
    if not edges:
        return found
    edge = {e.batch_no: e for e in edges}

    def of_batch(name: str) -> Column:
        values = [F.lit(edge[b][name] if b in edge else -1) for b in range(1, len(wanted) + 1)]
        return F.element_at(F.array(*values), F.col("batch_no"))

    inside = drawn.where(step == of_batch("step"))
    place = F.row_number().over(Window.partitionBy("batch_no").orderBy("draw", "position"))
    last = inside.withColumn("place", place).where(F.col("place") == ask - of_batch("before"))
    for row in last.collect():  # a row for each batch
        found[row.batch_no - 1] = (row.draw, row.position)
    return found


def introduce_exact_issues(
    rows: DataFrame, sizes: list[int], issue_rate: float = 0.05, duplicate_rate: float = 0.01
) -> DataFrame:
    """Dirty exactly ``int(n * issue_rate)`` rows of each batch of n rows, and land ``int(n * duplicate_rate)`` twice.

    ``rows`` come from ``split_contiguous``. Which rows are taken follows from their positions: those with the
    smallest draws, the earlier one of equal draws. Each kind of issue is as likely as another.
    """
    rows = rows.withColumn("_spread", scrambled(F.col("position")))

    def among_first(name: str, rate: float) -> Column:
        last = first_draws(rows, issues.draw(name), [int(n * rate) for n in sizes])
        draws, places = zip(*last, strict=True)

        def of_batch(values: tuple[int, ...]) -> Column:
            return F.element_at(F.array(*(F.lit(v).cast("bigint") for v in values)), F.col("batch_no"))

        own = issues.draw(name)
        return (own < of_batch(draws)) | ((own == of_batch(draws)) & (F.col("position") <= of_batch(places)))

    return issues.with_issues(rows, among_first("dirty", issue_rate), among_first("copy", duplicate_rate))


def generate_contiguous_batches(
    source: DataFrame,
    folder: str,
    num_batches: int = 3,
    issue_rate: float = 0.05,
    duplicate_rate: float = 0.01,
    columns: tuple[str, ...] = RAW_COLUMNS,
) -> list[str]:
    """Cut the source into batches by position, dirty each and write them as CSV. Returns the folders."""
    rows, sizes = split_contiguous(source, num_batches)
    dirty = introduce_exact_issues(rows, sizes, issue_rate, duplicate_rate)
    write_batches(dirty.select(*columns, "batch_no"), folder)
    return [f"{folder}/{FOLDER_NAME.format(n)}" for n in range(1, num_batches + 1)]
