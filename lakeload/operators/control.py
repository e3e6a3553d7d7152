"""Header and footer records inside landing files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.sources.schema import CORRUPT_COLUMN, FOOTER_DDL, HEADER_DDL

# Names of the stored columns, and those that a header and its footer share.
_FILE_COLUMNS = [
    "file_path", "file_name", "file_size", "file_modification_time",
    "file_block_start", "file_block_length",
]
_SYSTEM_COLUMNS = ["_slice_date", "_process_id", "_load_date"]
_MATCH = ["_process_id", "file_name", "_slice_date"]


def parse_control_line(line: Column, ddl: str) -> Column:
    """Parse one control line into a struct; fields that do not parse are null."""
    return F.from_csv(line, ddl)


def control_rows(raw: DataFrame, flag: str, process_id: int | None = None) -> DataFrame:
    """Records of one type, ``H`` or ``F``, optionally of one process."""
    rows = raw.where(F.col("flag") == flag)
    return rows if process_id is None else rows.where(F.col("_process_id") == process_id)


def parse_control(raw: DataFrame, part: str, process_id: int | None = None) -> DataFrame:
    """The ``header`` or ``footer`` records of a stored raw table, parsed, with their lineage."""
    flag, ddl = {"header": ("H", HEADER_DDL), "footer": ("F", FOOTER_DDL)}[part]
    return control_rows(raw, flag, process_id).select(
        parse_control_line(F.col(CORRUPT_COLUMN), ddl).alias(part),
        F.col(CORRUPT_COLUMN).alias(f"raw_{part}"),
        *(F.col(f"_metadata.{c}").alias(c) for c in _FILE_COLUMNS),
        *_SYSTEM_COLUMNS,
    )


def _footer_side(raw: DataFrame, process_id: int | None, keep: list[str]) -> DataFrame:
    footer = parse_control(raw, "footer", process_id)
    return footer.select("footer", "raw_footer", *(F.col(c).alias(f"_f_{c}") for c in keep))


def _matches(nulls_match: bool = False) -> Column:
    condition = F.lit(True)
    for c in _MATCH:
        same = F.col(c).eqNullSafe(F.col(f"_f_{c}")) if nulls_match else F.col(c) == F.col(f"_f_{c}")
        condition = condition & same
    return condition


def header_footer(raw: DataFrame, process_id: int | None = None, how: str = "inner") -> DataFrame:
    """Match the header and footer of each file.

    ``inner`` keeps complete files only; ``full`` also shows files whose header or footer is
    missing, with nulls on that side; there a file without a slice date is a file like any other.
    """
    if how not in ("inner", "full"):
        raise ValueError(f"how must be 'inner' or 'full', got {how!r}")
    shared = _FILE_COLUMNS + _SYSTEM_COLUMNS
    header = parse_control(raw, "header", process_id)
    footer = _footer_side(raw, process_id, shared)
    joined = header.join(footer, _matches(nulls_match=how == "full"), how)
    return joined.select(
        "header", "raw_header", "footer", "raw_footer",
        *(F.coalesce(c, f"_f_{c}").alias(c) if how == "full" else F.col(c) for c in shared),
    )


def header_footer_stream(raw: DataFrame, watermark: str | None = None, how: str = "inner") -> DataFrame:
    """The match of ``header_footer`` on a raw stream. Unmatched records wait in the join state.

    With ``watermark`` (for example ``"2 days"``) on the load time, a record whose partner has
    not come within that delay leaves the state, which bounds it; ``inner`` drops it, ``full`` gives it out with
    nulls on the other side. Without a watermark, which ``full`` needs, unmatched records are kept for good.
    Records that come later than the watermark allows are left out.
    """
    if how not in ("inner", "full"):
        raise ValueError(f"how must be 'inner' or 'full', got {how!r}")
    if how == "full" and not watermark:
        raise ValueError("a full match on a stream needs a watermark, or missing records would never come out")
    shared = _FILE_COLUMNS + _SYSTEM_COLUMNS
    header = parse_control(raw, "header")
    footer = _footer_side(raw, None, shared if how == "full" else [*_MATCH, "_load_date"])
    condition = _matches(nulls_match=how == "full")
    if watermark:
        header = header.withWatermark("_load_date", watermark)
        footer = footer.withWatermark("_f__load_date", watermark)
        delay = F.expr(f"interval {watermark}")
        condition = condition & F.col("_f__load_date").between(
            F.col("_load_date") - delay, F.col("_load_date") + delay
        )
    return header.join(footer, condition, how).select(
        "header", "raw_header", "footer", "raw_footer",
        *(F.coalesce(c, f"_f_{c}").alias(c) if how == "full" else F.col(c) for c in shared),
    )
