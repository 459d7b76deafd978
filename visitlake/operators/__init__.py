"""Operators from DataFrame to DataFrame. None of them runs a job or collects."""

from visitlake.operators.columns import rename_positional
from visitlake.operators.dedup import first_per_key
from visitlake.operators.labels import label_pairs, section_faults
from visitlake.operators.ranking import top_k, top_k_per_group

__all__ = [
    "first_per_key",
    "label_pairs",
    "rename_positional",
    "section_faults",
    "top_k",
    "top_k_per_group",
]
