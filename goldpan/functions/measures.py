"""Measures as reusable aggregate columns. Money is rounded to cents where it leaves an aggregate."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money_total(column: str, name: str) -> Column:
    return F.round(F.sum(column), 2).alias(name)


def money_average(column: str, name: str) -> Column:
    return F.round(F.avg(column), 2).alias(name)


def total_sales(column: str = "sales") -> Column:
    return money_total(column, "total_sales")


def total_profit(column: str = "profit") -> Column:
    return money_total(column, "total_profit")


def total_quantity(column: str = "quantity") -> Column:
    return F.sum(column).alias("total_quantity")


def line_count(name: str = "order_count") -> Column:
    """Order lines. Gold calls this ``order_count`` although an order may have several lines."""
    return F.count("order_id").alias(name)


def distinct_orders(name: str = "order_count") -> Column:
    return F.count_distinct("order_id").alias(name)


def row_count(name: str = "record_count") -> Column:
    return F.count("*").alias(name)


def margin_pct(profit: str | Column, sales: str | Column, name: str = "profit_margin_pct") -> Column:
    """Profit as a percentage of sales; NULL where sales are zero."""
    profit = F.col(profit) if isinstance(profit, str) else profit
    sales = F.col(sales) if isinstance(sales, str) else sales
    return F.round(F.try_divide(profit * 100.0, sales), 2).alias(name)
