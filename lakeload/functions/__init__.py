"""Column functions shared by the loading operators."""

from lakeload.functions.dates import (
    Timeslice,
    date_regex,
    directory_slice_date,
    slice_date_from,
)
from lakeload.functions.scalar import hash_value, row_hash, safe_ratio

__all__ = [
    "Timeslice", "date_regex", "directory_slice_date", "hash_value", "row_hash", "safe_ratio",
    "slice_date_from",
]
