"""Names, codes and the two parts of a port name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from visitlake.fixed import INVALID_COUNTRY, INVALID_COUNTRY_NAME

# Every character that counts as white space around a label.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip_label(text: Column) -> Column:
    """Take white space off both ends, then single quotes. What is inside stays as it is."""
    return F.btrim(F.btrim(text, F.lit(WHITE_SPACE)), F.lit("'"))


def label_id(code: str | Column) -> Column:
    """Whole number of a label code, NULL where the code is not one."""
    return (F.col(code) if isinstance(code, str) else code).try_cast("int")


def replace_invalid_country(name: str | Column) -> Column:
    return F.regexp_replace(name, INVALID_COUNTRY, INVALID_COUNTRY_NAME)


def port_city(name: str | Column, trim: bool = True) -> Column:
    """Text before the first comma, or the whole name when there is none."""
    city = F.get(F.split(name, ","), F.lit(0))
    return F.trim(city) if trim else city


def port_state(name: str | Column) -> Column:
    """Text between the first comma and the next one, NULL when there is no comma."""
    return F.trim(F.get(F.split(name, ","), F.lit(1)))
