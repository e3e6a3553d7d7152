"""The least and the greatest date or time that each run of a table holds, and bounds on them, as notes keep both."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, TimestampNTZType, TimestampType


def _told(value: Column, kind: DataType) -> Column:
    """A value as notes hold it: in order, and the same whatever the session's time zone is."""
    if isinstance(kind, TimestampType):
        return F.unix_micros(value)
    if isinstance(kind, (DateType, TimestampNTZType)):
        return value.cast("string")
    raise ValueError(f"rows expire by a date or a time, not by a {kind.simpleString()}")


def _meant(value: int | str, kind: str) -> Column:
    return F.timestamp_micros(F.lit(value)) if kind == "timestamp" else F.lit(value).cast(kind)


def spans(rows: DataFrame, column: str, run: str) -> dict[str, list]:
    """Least and greatest value by run: a row for each run, combined before the shuffle."""
    kind = rows.schema[column].dataType
    ends = (_told(end(column), kind) for end in (F.min, F.max))
    return {r: [least, greatest] for r, least, greatest in rows.groupBy(run).agg(*ends).collect()}


def bound_before(
    spark: SparkSession, newest: int | str | None, as_of: dt.datetime | str | None, days: int, kind: DataType
) -> int | str | None:
    """The value ``days`` before ``as_of``, or before ``newest`` as a note holds it; None if there is neither."""
    if as_of is None and newest is None:
        return None
    end = _meant(newest, kind.simpleString()) if as_of is None else F.lit(str(as_of)).cast(kind)
    start = (end - F.make_dt_interval(F.lit(days))).cast(kind)
    return spark.sql("select 1").select(_told(start, kind)).first()[0]


def from_bound(rows: DataFrame, column: str, value: int | str, kind: str) -> DataFrame:
    """Rows from a bound on, with the bound as a literal that reaches the scan."""
    return rows.where(F.col(column) >= _meant(value, kind).cast(rows.schema[column].dataType))
