"""Test batches: split a clean source into batches and dirty them, the same way on every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldpan.schema import RAW_COLUMNS
from goldpan.sources.csv_batches import FOLDER_NAME, write_batches

# The replacements for a valid discount or quantity.
INVALID_DISCOUNTS = (1.5, -0.1, 2.0)
INVALID_QUANTITIES = (0, -1, -2)

# The kinds of issue; "duplicate" changes nothing by itself, see below.
ISSUE_KINDS = ("null_sales", "null_product_id", "duplicate", "invalid_discount", "invalid_quantity")

# Draws are multiples of 1 / PRIME; each uses a factor of its own, so that one says nothing about another.
PRIME = 2_147_483_647
_FACTORS = {"dirty": 16_807, "kind": 48_271, "choice": 69_621, "copy": 39_373}


def row_spread(df: DataFrame) -> Column:
    """A number spread evenly over the rows, from their content alone."""
    return F.pmod(F.xxhash64(*(F.col(f"`{c}`") for c in df.columns)), F.lit(PRIME))


def draw(name: str, spread: str = "_spread") -> Column:
    """A whole number from 0 to ``PRIME`` - 1 for each row."""
    return (F.col(spread) % PRIME * _FACTORS[name]) % PRIME


def introduce_quality_issues(
    df: DataFrame,
    issue_rate: float = 0.05,
    duplicate_rate: float = 0.01,
    spread: Column | None = None,
) -> DataFrame:
    """Dirty a share of the rows, each kind of issue equally often, and land some rows twice.

    Which row gets what follows from ``spread`` (a non-negative whole number per row), so a task
    that runs again makes the same rows. The kind "duplicate" changes nothing by itself: copies
    come from the last step, one pass without a second scan.
    """
    spread = row_spread(df) if spread is None else spread
    numbered = df.withColumn("_spread", spread.cast("bigint"))
    return with_issues(numbered, draw("dirty") < issue_rate * PRIME, draw("copy") < duplicate_rate * PRIME)


def with_issues(numbered: DataFrame, dirty: Column, twice: Column) -> DataFrame:
    """Dirty the rows that ``dirty`` names and land those that ``twice`` names twice; ``_spread`` decides the rest."""
    kind = F.floor(draw("kind") * len(ISSUE_KINDS) / PRIME)
    choice = F.floor(draw("choice") * len(INVALID_DISCOUNTS) / PRIME).cast("int") + 1

    def has(issue: str) -> Column:
        return dirty & (kind == ISSUE_KINDS.index(issue))

    def pick(values: tuple) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), choice)

    copies = F.when(twice, 2).otherwise(1)
    return (
        numbered.withColumns(
            {
                "Sales": F.when(~has("null_sales"), F.col("Sales")),
                "Product ID": F.when(~has("null_product_id"), F.col("Product ID")),
                "Discount": F.when(has("invalid_discount"), pick(INVALID_DISCOUNTS)).otherwise(
                    F.col("Discount")
                ),
                "Quantity": F.when(has("invalid_quantity"), pick(INVALID_QUANTITIES)).otherwise(
                    F.col("Quantity")
                ),
                "_copy": F.explode(F.array_repeat(F.lit(1), copies)),
            }
        )
        .drop("_spread", "_copy")
    )


def assign_batches(df: DataFrame, key: Column, num_batches: int = 3) -> DataFrame:
    """Number the batches 1 to ``num_batches`` by a whole-number key; all rows of a key go together.

    A rule on the key needs no global row order, hence no shuffle.
    """
    return df.withColumn("batch_no", (F.pmod(key, F.lit(num_batches)) + 1).cast("int"))


def generate_batches(
    source: DataFrame,
    folder: str,
    key: Column,
    num_batches: int = 3,
    issue_rate: float = 0.05,
    spread: Column | None = None,
    columns: tuple[str, ...] = RAW_COLUMNS,
) -> list[str]:
    """Write the dirtied rows as CSV, a folder per batch, in one pass. Returns the folders."""
    batches = assign_batches(source, key, num_batches)
    dirty = introduce_quality_issues(batches, issue_rate, spread=spread)
    write_batches(dirty.select(*columns, "batch_no"), folder)
    return [f"{folder}/{FOLDER_NAME.format(n)}" for n in range(1, num_batches + 1)]
