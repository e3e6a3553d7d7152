"""Row order on disk, so that scans skip files and row groups by their min/max statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a column's rank, rows sampled for the quantiles that make the ranks.
BITS, SAMPLED = 6, 10_000


def cluster(df: DataFrame, columns: list[str], partitions: int | None = None, first: list[str] | None = None) -> DataFrame:
    """Range-partition and sort by the columns, within the values of the columns ``first``.

    One column is sorted. Several are ranked by sampled quantiles and the bits of their ranks interleaved, so
    each file holds a narrow range of every column and a filter on any of them skips most files; sorting by one
    after the other would serve the first alone. The quantiles take a job of their own over these columns.

    A row hash follows in the range key, so one value holding a large share of the rows is spread over several
    files instead of landing in one task.
    """
    places = [F.col(f"`{c}`") for c in first or []]
    if len(columns) > 1:
        places.append(interleaved(df, columns))
    order = [*places, *(F.col(f"`{c}`") for c in columns)]
    spread = [*(places if len(columns) > 1 else order), F.xxhash64(*(f"`{c}`" for c in df.columns))]
    if partitions is None:
        ranged = df.repartitionByRange(*spread)
    else:
        ranged = df.repartitionByRange(partitions, *spread)
    return ranged.sortWithinPartitions(*order)


def interleaved(df: DataFrame, columns: list[str], bits: int = BITS) -> Column:
    """The ranks of the columns with their bits taken in turn, the highest of the first column in front."""
    cuts, place = _cuts(df, columns, 1 << bits), F.lit(0).cast("long")
    for i, column in enumerate(columns):
        shifts = [bit * len(columns) + len(columns) - 1 - i for bit in range(bits)]
        apart = [sum((rank >> bit & 1) << shift for bit, shift in enumerate(shifts)) for rank in range(1 << bits)]
        place = place.bitwiseOR(_rank(F.col(f"`{column}`"), cuts[i], apart))
    return place


def _cuts(df: DataFrame, columns: list[str], parts: int) -> list[list]:
    """Values that cut each column into parts with equally many sampled rows; equal ones count once.

    The sample are the ``SAMPLED`` rows with the least hash of their place, so its size does not grow.
    """
    if len(columns) * BITS > 62:
        raise ValueError(f"at most {62 // BITS} columns can be interleaved")
    row = F.struct(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns))).alias("row")
    dealt = df.select(row, F.xxhash64(F.monotonically_increasing_id()).alias("dealt"))
    sample = [r["row"] for r in dealt.orderBy("dealt").limit(SAMPLED).collect()]
    out = []
    for i in range(len(columns)):
        # Nulls and NaN have no place among the values; they get the first and the last rank.
        held = sorted(v for r in sample if (v := r[i]) is not None and v == v)
        at = (held[len(held) * k // parts] for k in range(1, parts))
        out.append(list(dict.fromkeys(at)) if held else [])
    return out


def _rank(value: Column, cuts: list, names: list[int]) -> Column:
    """``names`` of how many cuts are not above the value, found by halving; the first for null."""

    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(names[low]).cast("long")
        middle = (low + high) // 2
        return F.when(value >= F.lit(cuts[middle]), between(middle + 1, high)).otherwise(between(low, middle))

    return F.when(value.isNull(), F.lit(names[0]).cast("long")).otherwise(between(0, len(cuts)))
