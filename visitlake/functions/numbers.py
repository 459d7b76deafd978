"""Whole numbers out of columns that may hold anything."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def whole_number(value: str | Column) -> Column:
    """The int that a value is, NULL where it is a fraction, out of range or no number."""
    number = (F.col(value) if isinstance(value, str) else value).try_cast("double")
    return F.when(number == F.floor(number), number).try_cast("int")


def not_whole(value: str | Column) -> Column:
    """True where a value is given but is no whole number."""
    value = F.col(value) if isinstance(value, str) else value
    return value.isNotNull() & whole_number(value).isNull()
