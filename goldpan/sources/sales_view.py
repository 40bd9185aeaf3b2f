"""Raw sales batches as a view over the supplied star schema.

Order lines are the fact; orders, customers and parts describe them. A caller names the raw
columns it needs and only the tables that supply them are joined: dimension keys are unique and
the joins are left outer, so leaving a dimension out never changes the rows. No join carries a
broadcast hint. Spark broadcasts a side only below ``autoBroadcastJoinThreshold``; beyond it the
sort-merge join runs, whose hot keys adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from goldpan.operators.silver import standardize_sales_columns
from goldpan.schema import BUSINESS_COLUMNS, LINEAGE_COLUMNS, RAW_COLUMNS, RAW_NAME, SILVER_COLUMNS

# When each batch arrives, first batch first.
ARRIVALS = ("2024-01-01 08:00:00", "2024-01-02 08:00:00", "2024-01-03 08:00:00")
BATCHES = len(ARRIVALS)

_FROM_REGION = {"Region"}
_FROM_NATION = {"Country", "State", "City"} | _FROM_REGION
_FROM_CUSTOMER = {"Customer Name", "Segment"} | _FROM_NATION
_FROM_ORDERS = {"Order Date", "Ship Mode", "Customer ID", "Postal Code"} | _FROM_CUSTOMER
_FROM_PART = {"Category", "Sub-Category", "Product Name", "Profit"}


_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A supplied table. Its schema is looked up once: each lookup is a job that opens a file."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def batch_of(order_key: Column) -> Column:
    """Arrival batch of an order, 1 to 3."""
    return (order_key % BATCHES + 1).cast("int")


def dirt_slot() -> Column:
    """Deterministic slot 0 to 100 of a line; slots 0 to 4 carry the injected issues."""
    return (F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 101


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their batch. Slot 4 lands a second time in the next batch."""
    batch = batch_of(F.col("l_orderkey"))
    landings = F.when(dirt_slot() == 4, F.array(batch, batch % BATCHES + 1)).otherwise(F.array(batch))
    return table(spark, sf_dir, "lineitem").select("*", F.explode(landings).alias("batch_no"))


def _customers(spark: SparkSession, sf_dir: str, needed: set[str]) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    if needed & _FROM_NATION:
        nations = table(spark, sf_dir, "nation")
        if needed & _FROM_REGION:
            regions = table(spark, sf_dir, "region")
            nations = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        customers = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return customers


def _orders(spark: SparkSession, sf_dir: str, needed: set[str]) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    if needed & _FROM_CUSTOMER:
        customers = _customers(spark, sf_dir, needed)
        orders = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left")
    return orders


_RAW_EXPRESSIONS = {
    "Order ID": lambda: F.col("l_orderkey").cast("string"),
    "Order Date": lambda: F.col("o_orderdate"),
    "Ship Date": lambda: F.col("l_shipdate"),
    "Ship Mode": lambda: F.concat(F.lit(" "), F.col("o_orderpriority"), F.lit(" ")),
    "Customer ID": lambda: F.col("o_custkey").cast("string"),
    "Customer Name": lambda: F.col("c_name"),
    "Segment": lambda: F.col("c_mktsegment"),
    "Country": lambda: F.col("n_name"),
    "City": lambda: F.concat(F.col("n_name"), F.lit("-"), (F.col("o_custkey") % 10).cast("string")),
    "State": lambda: F.col("n_name"),
    "Postal Code": lambda: F.lpad(F.col("o_custkey").cast("string"), 5, "0"),
    "Region": lambda: F.col("r_name"),
    "Product ID": lambda: F.when(dirt_slot() != 1, F.col("l_partkey").cast("string")),
    "Category": lambda: F.col("p_type"),
    "Sub-Category": lambda: F.col("p_brand"),
    "Product Name": lambda: F.col("p_name"),
    "Sales": lambda: F.when(dirt_slot() != 0, F.col("l_extendedprice")),
    "Quantity": lambda: F.when(dirt_slot() == 3, 0).otherwise(F.col("l_quantity").cast("int")),
    "Discount": lambda: F.when(dirt_slot() == 2, 1.5).otherwise(F.col("l_discount")),
    "Profit": lambda: F.col("l_extendedprice") - F.col("l_quantity") * F.col("p_retailprice"),
}


def _lineage() -> dict[str, Column]:
    def by_batch(*values: str, kind: str = "string") -> Column:
        return F.element_at(F.array(*(F.lit(v).cast(kind) for v in values)), F.col("batch_no"))

    arrival = by_batch(*ARRIVALS, kind="timestamp")
    numbers = range(1, BATCHES + 1)
    return {
        "ingestion_date": F.to_date(arrival),
        "ingestion_ts": arrival,
        "source_file": by_batch(*(f"sales_batch_{n:03d}.csv" for n in numbers)),
        "source_system": F.lit("sales_system"),
        "batch_id": by_batch(*(f"batch_{n}" for n in numbers)),
    }


def _described(spark: SparkSession, sf_dir: str, rows: DataFrame, wanted: tuple[str, ...], keep: tuple[str, ...]) -> DataFrame:
    """Order lines with the tables joined that the wanted raw columns come from."""
    needed = set(wanted)
    if needed & _FROM_ORDERS:
        orders = _orders(spark, sf_dir, needed)
        rows = rows.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    if needed & _FROM_PART:
        parts = table(spark, sf_dir, "part")
        rows = rows.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
    return rows.select(
        *(_RAW_EXPRESSIONS[name]().alias(name) for name in wanted),
        *(column.alias(name) for name, column in _lineage().items()),
        *keep,
    )


def bronze(spark: SparkSession, sf_dir: str, *raw_columns: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Bronze rows of all batches: the named raw columns (default all) and the lineage columns.

    ``keep`` adds further columns of the order lines, or ``batch_no``.
    """
    return _described(spark, sf_dir, _lines(spark, sf_dir), raw_columns or RAW_COLUMNS, keep)


def _first_lines(spark: SparkSession, sf_dir: str, each_batch: bool) -> DataFrame:
    """Complete order lines, the first of each natural key, before anything is joined to them.

    Key and order come from the lines alone. The order is that of ``ARRIVAL_ORDER``: within a key the part
    is one and the same, so at equal sales a smaller profit is a larger quantity as ordered. The line
    number ends every tie. Lines are dealt by order, which also serves the join with the orders.
    """
    complete = _lines(spark, sf_dir).where(
        F.col("l_orderkey").isNotNull()
        & F.col("l_partkey").isNotNull()
        & F.col("l_extendedprice").isNotNull()
        & ~dirt_slot().isin(0, 1)
    )
    key = ["l_orderkey", "l_partkey", *(["batch_no"] if each_batch else [])]
    order = [
        F.col("batch_no"),
        F.col("l_extendedprice"),
        _RAW_EXPRESSIONS["Quantity"](),
        _RAW_EXPRESSIONS["Discount"](),
        F.desc("l_quantity"),
        F.col("l_shipdate"),
        F.col("l_linenumber"),
    ]
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    return complete.repartition("l_orderkey").withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def raw_inputs(*columns: str) -> tuple[str, ...]:
    """The raw columns behind the named Silver columns, in the order of the header."""
    wanted = columns or SILVER_COLUMNS
    return tuple(RAW_NAME[c.name] for c in BUSINESS_COLUMNS if c.name in wanted)


def cleaned(spark: SparkSession, sf_dir: str, *raw_columns: str, each_batch: bool = False) -> DataFrame:
    """Bronze rows that stay in Silver; with ``each_batch`` copies in other batches stay too."""
    return _described(spark, sf_dir, _first_lines(spark, sf_dir, each_batch), raw_columns or RAW_COLUMNS, ())


def standardized(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Bronze renamed, typed and trimmed, before any row is dropped."""
    wanted = columns or SILVER_COLUMNS
    return standardize_sales_columns(bronze(spark, sf_dir, *raw_inputs(*wanted)), columns=wanted)


def silver(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Cleaned rows with the named Silver columns (default all 25)."""
    wanted = columns or SILVER_COLUMNS
    rows = cleaned(spark, sf_dir, *raw_inputs(*wanted))
    return standardize_sales_columns(rows, columns=wanted).select(*wanted)
