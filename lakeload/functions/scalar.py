"""Small column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(part: Column, whole: Column) -> Column:
    """``part / whole`` as a double, 0.0 when ``whole`` is zero or null (safe under ANSI mode)."""
    empty = F.coalesce(whole, F.lit(0)) == 0
    return F.when(empty, F.lit(0.0)).otherwise(part.cast("double") / whole)


def hash_value(value: Column, bits: int = 224) -> Column:
    """Hex SHA-2 digest of the text of one value."""
    return F.sha2(value.cast("string"), bits)


def row_hash(columns: list[str], bits: int = 256, separator: str | None = None) -> Column:
    """Hex SHA-2 digest of several columns.

    By default the columns are encoded as JSON with nulls kept, so null, empty text and shifted
    values all hash differently. With ``separator`` they are joined as text, nulls left out.
    """
    if separator is None:
        text = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    else:
        text = F.concat_ws(separator, *(F.col(c).cast("string") for c in columns))
    return F.sha2(text, bits)
