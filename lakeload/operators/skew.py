"""Splitting hot keys into ordered pieces, so that no key has to fit one task."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.sinks.scratch import scratch_dir

# A key with more rows than this is split into pieces of about this many rows.
SPLIT_ROWS = 5_000_000
# A piece never holds less than 1/MAX_SPLITS of all rows, so there are at most MAX_SPLITS hot keys
# and about as many cut points, however large the table: their broadcast has a fixed bound.
MAX_SPLITS = 20_000


def same_keys(left: str, right: str, keys: list[str]) -> Column:
    """Null-safe equality of the keys of two aliased DataFrames."""
    return reduce(
        lambda a, b: a & b, (F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys)
    )


def split_hot_keys(
    df: DataFrame, keys: list[str], order: list[str], split_rows: int | None = SPLIT_ROWS
) -> tuple[DataFrame, DataFrame | None]:
    """(rows of keys of normal size, rows of hot keys with ``_split``), the latter often None.

    ``_split`` is a piece number that grows along ``order`` within each hot key. One narrow
    counting job (keys only, combined map-side) decides whether any key is hot;
    ``split_rows=None`` skips it. Exact copies among the rows of hot keys are dropped, so copies
    of one row cannot fill a piece.
    """
    if split_rows is None:
        return df, None
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    total, largest = counts.agg(F.sum("_rows"), F.max("_rows")).first()
    limit = max(split_rows, math.ceil((total or 0) / MAX_SPLITS))
    if (largest or 0) <= limit:
        return df, None

    hot = F.broadcast(_cut_points(df, counts.where(F.col("_rows") > limit), keys, order, limit))
    same = same_keys("r", "h", keys)
    cold_rows = df.alias("r").join(hot.alias("h"), same, "left_anti")

    # Two levels of cuts make finding a row's piece cost the square root of their number.
    point = F.struct(*order)
    block = F.size(F.filter("h._blocks", lambda b: b[0] <= point))
    inside = F.size(F.filter(F.get("h._blocks", block - 1), lambda c: c <= point))
    split = F.when(block == 0, F.lit(0)).otherwise((block - 1) * F.col("h._width") + inside)
    hot_rows = df.alias("r").join(hot.alias("h"), same).select("r.*", split.alias("_split"))
    return cold_rows, hot_rows.distinct()


def _cut_points(
    df: DataFrame, hot: DataFrame, keys: list[str], order: list[str], limit: int
) -> DataFrame:
    """Per hot key its cut points in blocks, as a small written table that cuts the lineage.

    About every limit-th row, chosen by hash, becomes a cut point. The choice only places the
    cuts: all rows are kept. A key of few distinct rows may have none and is one piece.
    """
    hot = F.broadcast(hot.select(*keys))
    cuts = (
        df.alias("r")
        .join(hot.alias("h"), same_keys("r", "h", keys), "left_semi")
        .where(F.pmod(F.xxhash64(*order), F.lit(limit)) == 0)
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_set(F.struct(*order))).alias("_cuts"))
    )
    size = F.coalesce(F.size("_cuts"), F.lit(0))
    width = F.greatest(F.lit(1), F.ceil(F.sqrt(size))).cast("int")
    starts = F.when(size > 0, F.sequence(F.lit(1), size, width)).otherwise(F.array())
    blocks = F.transform(starts.cast("array<int>"), lambda i: F.slice("_cuts", i, width))
    table = hot.alias("h").join(cuts.alias("c"), same_keys("h", "c", keys), "left")
    path = scratch_dir(df.sparkSession, "cuts")
    table.select("h.*", blocks.alias("_blocks"), width.alias("_width")).write.parquet(path)
    return df.sparkSession.read.parquet(path)
