"""Day numbers counted from 1960-01-01."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

SAS_EPOCH = date(1960, 1, 1)
FIRST_DAY = (date.min - SAS_EPOCH).days
LAST_DAY = (date.max - SAS_EPOCH).days


def sas_date(days: str | Column) -> Column:
    """Date of a SAS day number.

    A fraction is floored. NULL and 0 give NULL, and so does a number that names no day of the
    years 1 to 9999 (NaN and the infinities among them): one bad record must not end the job.
    """
    number = _number(days)
    in_calendar = (number >= F.lit(FIRST_DAY)) & (number < F.lit(LAST_DAY + 1))
    return F.when(
        (number != F.lit(0)) & in_calendar,
        F.date_add(F.lit(SAS_EPOCH), F.floor(number).cast("int")),
    )


def unreadable_sas_date(days: str | Column) -> Column:
    """True where a day number is given but names no date."""
    number = _number(days)
    return F.coalesce(number != F.lit(0), F.lit(False)) & sas_date(days).isNull()


def _number(days: str | Column) -> Column:
    return (F.col(days) if isinstance(days, str) else days).cast("double")
