"""Writers of the lake."""

from visitlake.sinks.lake import refresh_month, write_dimension, write_visits

__all__ = ["refresh_month", "write_dimension", "write_visits"]
