"""Load audits per file, their thresholds, and reconciliation with stated row counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.functions.scalar import safe_ratio
from lakeload.sources.schema import THRESHOLDS_SCHEMA

_FILE = ["file_name", "file_path", "file_size", "file_modification_time"]
_BLOCK = ["file_block_start", "file_block_length"]
_SYSTEM = ["_slice_date", "_process_id", "_load_date"]


def merge_thresholds(stage: dict | None, table: dict | None) -> dict:
    """Stage-wide thresholds with the table's own ones on top."""
    return {**(stage or {}), **(table or {})}


def thresholds_struct(thresholds: dict | None) -> Column:
    """A struct of the four thresholds; those not set are typed nulls."""
    given = thresholds or {}
    unknown = set(given) - set(THRESHOLDS_SCHEMA.fieldNames())
    if unknown:
        raise ValueError(f"unknown thresholds: {sorted(unknown)}")
    return F.struct(*(
        F.lit(given.get(f.name)).cast(f.dataType).alias(f.name) for f in THRESHOLDS_SCHEMA.fields
    ))


class ThresholdBreach(Exception):
    """A load went over one of its exception thresholds."""


def enforce_thresholds(audited: DataFrame, shown: int = 20) -> None:
    """Raise when any file has the status ``exception``. Call it after the audit is stored."""
    broken = evaluate_thresholds(audited).where("status = 'exception'")
    count = broken.count()
    if count:
        names = [r.file_name for r in broken.select("file_name").limit(shown).collect()]
        raise ThresholdBreach(f"{count} files over their exception thresholds, such as {names}")


def audit(
    raw: DataFrame,
    process_id: int,
    source: tuple[str, str],
    target: tuple[str, str],
    warning: dict | None = None,
    exception: dict | None = None,
    header_footer: DataFrame | None = None,
    grain: str = "file",
) -> DataFrame:
    """Row counts of each file one process loaded, beside its thresholds.

    ``source`` and ``target`` are (database, table). With ``header_footer`` the stated row count
    is joined on; files without a control record drop out. Rows are counted per file before that
    join, so it only sees one row per file. ``grain="block"`` gives one row per file block as
    Spark read it; the default sums a file up whatever its blocks were.
    """
    if grain not in ("file", "block"):
        raise ValueError(f"grain must be 'file' or 'block', got {grain!r}")
    file_keys = [F.col(f"_metadata.{c}").alias(c) for c in _FILE + (_BLOCK if grain == "block" else [])]
    counts = (
        raw.where(F.col("_process_id") == process_id)
        .groupBy(*file_keys, *([] if header_footer is not None else _SYSTEM))
        .agg(
            F.count(F.lit(1)).alias("total_count"),
            F.count_if(F.col("_is_valid")).alias("valid_count"),
            F.count_if(~F.coalesce(F.col("_is_valid"), F.lit(False))).alias("invalid_count"),
        )
    )
    if grain == "file":
        counts = counts.withColumns({
            "file_block_start": F.lit(0).cast("long"),
            "file_block_length": F.col("file_size"),
        })
    if header_footer is not None:
        stated = (
            header_footer.where(F.col("_process_id") == process_id)
            .select("file_name", F.col("header.row_count").alias("expected_row_count"), *_SYSTEM)
            .distinct()
        )
        counts = counts.join(stated, "file_name")
    return counts.select(
        "file_name",
        F.lit(source[0]).alias("source_database"),
        F.lit(source[1]).alias("source_table"),
        F.lit(target[0]).alias("database"),
        F.lit(target[1]).alias("table"),
        "total_count",
        "valid_count",
        "invalid_count",
        safe_ratio(F.col("invalid_count"), F.col("total_count")).alias("invalid_ratio"),
        *(["expected_row_count"] if header_footer is not None else []),
        thresholds_struct(warning).alias("warning_thresholds"),
        thresholds_struct(exception).alias("exception_thresholds"),
        "file_path",
        "file_size",
        "file_modification_time",
        *_BLOCK,
        *_SYSTEM,
    )


def _breach(level: str) -> Column:
    def over(value: str, limit: str) -> Column:
        return F.coalesce(F.col(value) > F.col(f"{level}.{limit}"), F.lit(False))

    return (
        over("invalid_ratio", "invalid_ratio")
        | over("invalid_count", "invalid_rows")
        | over("total_count", "max_rows")
        | F.coalesce(F.col("total_count") < F.col(f"{level}.min_rows"), F.lit(False))
    )


def evaluate_thresholds(audited: DataFrame) -> DataFrame:
    """Add ``status``: ``exception``, ``warning`` or ``ok``. A threshold must be passed to count."""
    status = (
        F.when(_breach("exception_thresholds"), "exception")
        .when(_breach("warning_thresholds"), "warning")
        .otherwise("ok")
    )
    return audited.withColumn("status", status)


def reconcile(audited: DataFrame) -> DataFrame:
    """Add ``is_reconciled``: the valid rows loaded equal the row count the header states."""
    return audited.withColumn("is_reconciled", F.col("valid_count") == F.col("expected_row_count"))
