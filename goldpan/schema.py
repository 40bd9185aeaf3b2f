"""Column contract of the sales data: one entry per business column, plus the lineage columns."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class SalesColumn:
    raw: str
    name: str
    type: str = "string"
    trimmed: bool = False


# Source headers, Silver names and types, in the order of the Silver table.
BUSINESS_COLUMNS = (
    SalesColumn("Order ID", "order_id"),
    SalesColumn("Order Date", "order_date", "timestamp_ntz"),
    SalesColumn("Ship Date", "ship_date", "timestamp_ntz"),
    SalesColumn("Ship Mode", "ship_mode", trimmed=True),
    SalesColumn("Customer ID", "customer_id"),
    SalesColumn("Customer Name", "customer_name"),
    SalesColumn("Segment", "segment", trimmed=True),
    SalesColumn("Country", "country", trimmed=True),
    SalesColumn("City", "city", trimmed=True),
    SalesColumn("State", "state", trimmed=True),
    SalesColumn("Postal Code", "postal_code"),
    SalesColumn("Region", "region", trimmed=True),
    SalesColumn("Product ID", "product_id"),
    SalesColumn("Category", "category", trimmed=True),
    SalesColumn("Sub-Category", "sub_category", trimmed=True),
    SalesColumn("Product Name", "product_name", trimmed=True),
    SalesColumn("Sales", "sales", "double"),
    SalesColumn("Quantity", "quantity", "int"),
    SalesColumn("Discount", "discount", "double"),
    SalesColumn("Profit", "profit", "double"),
)

LINEAGE_COLUMNS = ("ingestion_date", "ingestion_ts", "source_file", "source_system", "batch_id")

# The lineage columns the short Silver projection keeps.
SHORT_LINEAGE_COLUMNS = ("ingestion_date", "ingestion_ts", "batch_id")

RAW_COLUMNS = tuple(c.raw for c in BUSINESS_COLUMNS)
SILVER_COLUMNS = tuple(c.name for c in BUSINESS_COLUMNS) + LINEAGE_COLUMNS
RAW_NAME = {c.name: c.raw for c in BUSINESS_COLUMNS}

NATURAL_KEY = ("order_id", "product_id")
CRITICAL_COLUMNS = ("order_id", "product_id", "sales")

# Which copy of a natural key survives: the one that arrived first, then the smallest measures.
# Every other column follows these, so a re-run keeps the same row.
ARRIVAL_ORDER = (
    "ingestion_ts",
    "batch_id",
    "sales",
    "quantity",
    "discount",
    "profit",
    "ship_date",
)
