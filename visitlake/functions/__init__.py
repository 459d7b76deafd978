"""Column expressions. All of them are built-in functions, so they stay inside generated code."""

from visitlake.functions.dates import sas_date, unreadable_sas_date
from visitlake.functions.numbers import not_whole, whole_number
from visitlake.functions.text import (
    label_id,
    port_city,
    port_state,
    replace_invalid_country,
    strip_label,
)

__all__ = [
    "label_id",
    "not_whole",
    "port_city",
    "port_state",
    "replace_invalid_country",
    "sas_date",
    "strip_label",
    "unreadable_sas_date",
    "whole_number",
]
