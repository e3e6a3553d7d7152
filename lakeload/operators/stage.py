"""Staging: source columns plus validity, slice, process, load time and file lineage."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.functions.dates import directory_slice_date, slice_date_from
from lakeload.sources.schema import CORRUPT_COLUMN


def stage(
    df: DataFrame,
    process_id: int | None,
    slice_format: str = "%Y%m%d",
    slice_from: str | None = "file",
    meta_first: bool = False,
    validity: bool = True,
    load_date: Column | None = None,
    corrupt_column: str = CORRUPT_COLUMN,
) -> DataFrame:
    """Project landing rows to the layout of a raw table; works on batch and stream.

    ``slice_from`` is ``file``, ``path`` or None (a typed null slice date). ``process_id=None``
    and ``validity=False`` leave those columns out, ``meta_first`` puts the lineage first.
    """
    source = [c for c in df.columns if not c.startswith("_")]
    system = [c for c in df.columns if c.startswith("_") and c != "_metadata"]
    if slice_from is None:
        slice_date = F.lit(None).cast("timestamp")
    elif slice_from == "file":
        slice_date = slice_date_from(F.col("_metadata.file_name"), slice_format)
    elif slice_from == "path":
        path, name = F.col("_metadata.file_path"), F.col("_metadata.file_name")
        slice_date = directory_slice_date(path, name, slice_format)
    else:
        raise ValueError(f"slice_from must be 'file', 'path' or None, got {slice_from!r}")
    lineage = []
    if validity:
        lineage.append(F.col(corrupt_column).isNull().alias("_is_valid"))
    lineage.append(slice_date.alias("_slice_date"))
    if process_id is not None:
        lineage.append(F.lit(process_id).cast("long").alias("_process_id"))
    lineage.append((F.current_timestamp() if load_date is None else load_date).alias("_load_date"))
    lineage.append(F.col("_metadata"))
    data = [F.col(f"`{c}`") for c in source + system]
    return df.select(*(lineage + data if meta_first else data + lineage))


def valid_rows(df: DataFrame) -> DataFrame:
    return df.where("_is_valid")


def quarantine(df: DataFrame) -> DataFrame:
    """The rows ``valid_rows`` leaves out."""
    return df.where("not coalesce(_is_valid, false)")


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantined) rows of a stored raw table."""
    return valid_rows(df), quarantine(df)


def inserted_rows(changes: DataFrame) -> DataFrame:
    """The inserts of a table's change feed, as ``change_feed`` computes it, without the feed's own columns.

    An append-only table read as a stream gives the same rows without a feed.
    """
    return changes.where("_change_type = 'insert'").drop(
        "_change_type", "_commit_version", "_commit_timestamp"
    )


def retain(
    df: DataFrame, days: int, as_of: dt.datetime | str | None = None, column: str = "_slice_date"
) -> DataFrame:
    """Rows not older than ``days`` before ``as_of``, by default the newest value of the column.

    The bound is a literal, so it reaches the scan as a pushed filter. It travels as text to keep
    it in the session's time zone.
    """
    kind = df.schema[column].dataType
    newest = F.max(column) if as_of is None else F.max(F.lit(str(as_of)).cast(kind))
    bound = df.agg((newest - F.make_dt_interval(F.lit(days))).cast("string")).first()[0]
    return df.where(F.col(column) >= F.lit(bound).cast(kind))
