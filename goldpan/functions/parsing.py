"""Conversions that turn bad text into NULL instead of failing the job under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of a date that the ISO parser does not take, in the order they are tried.
EXTRA_DATE_FORMATS = ("M/d/yyyy", "d-M-yyyy")


def to_type(column: Column, type_name: str, is_text: bool = True) -> Column:
    """``column`` as ``type_name``, NULL where the text does not fit.

    A whole number may be spelled with decimals ("3.0"), a date in one of several ways.
    """
    if type_name == "string":
        return column.cast("string")
    if type_name == "int":
        return column.try_cast("double").try_cast("int")
    if type_name.startswith("timestamp") and is_text:
        others = [F.try_to_timestamp(column, F.lit(f)).cast(type_name) for f in EXTRA_DATE_FORMATS]
        return F.coalesce(column.try_cast(type_name), *others)
    return column.try_cast(type_name)
