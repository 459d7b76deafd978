"""Readers for the three inputs and for the tables of the lake."""

from visitlake.sources.demography import read_demography
from visitlake.sources.labels import read_label_lines
from visitlake.sources.lake import (
    read_counts,
    read_dimension,
    read_months,
    read_star,
    read_visits,
    register_views,
)
from visitlake.sources.visits import read_raw_visits

__all__ = [
    "read_counts",
    "read_demography",
    "read_dimension",
    "read_label_lines",
    "read_months",
    "read_raw_visits",
    "read_star",
    "read_visits",
    "register_views",
]
