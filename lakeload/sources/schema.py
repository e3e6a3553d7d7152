"""Schemas kept in files, inferred schemas, and the schemas of the control tables."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql.types import (
    DataType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

try:
    import yaml
except ImportError:  # JSON schema files still work
    yaml = None

CORRUPT_COLUMN = "_corrupt_record"

# Layouts of control lines and of the stored control tables.
HEADER_DDL = "flag string, row_count long, period long, batch string"
FOOTER_DDL = "flag string, name string, period long"

_STRING, _LONG, _DOUBLE, _TIMESTAMP = StringType(), LongType(), DoubleType(), TimestampType()


def _schema(fields: dict[str, DataType]) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


_FILE = {
    "file_path": _STRING,
    "file_name": _STRING,
    "file_size": _LONG,
    "file_modification_time": _TIMESTAMP,
    "file_block_start": _LONG,
    "file_block_length": _LONG,
}
_SYSTEM = {"_slice_date": _TIMESTAMP, "_process_id": _LONG, "_load_date": _TIMESTAMP}

METADATA_SCHEMA = _schema({
    "file_path": _STRING,
    "file_name": _STRING,
    "file_size": _LONG,
    "file_block_start": _LONG,
    "file_block_length": _LONG,
    "file_modification_time": _TIMESTAMP,
})
THRESHOLDS_SCHEMA = _schema({
    "invalid_ratio": _DOUBLE,
    "invalid_rows": _LONG,
    "max_rows": _LONG,
    "min_rows": _LONG,
})
HEADER_FOOTER_SCHEMA = _schema({
    "header": _schema({"flag": _STRING, "row_count": _LONG, "period": _LONG, "batch": _STRING}),
    "raw_header": _STRING,
    "footer": _schema({"flag": _STRING, "name": _STRING, "period": _LONG}),
    "raw_footer": _STRING,
    **_FILE,
    **_SYSTEM,
})


def _audit_schema(expected: dict[str, DataType]) -> StructType:
    named = {k: v for k, v in _FILE.items() if k != "file_name"}
    return _schema({
        "file_name": _STRING,
        "source_database": _STRING,
        "source_table": _STRING,
        "database": _STRING,
        "table": _STRING,
        "total_count": _LONG,
        "valid_count": _LONG,
        "invalid_count": _LONG,
        "invalid_ratio": _DOUBLE,
        **expected,
        "warning_thresholds": THRESHOLDS_SCHEMA,
        "exception_thresholds": THRESHOLDS_SCHEMA,
        **named,
        **_SYSTEM,
    })


AUDIT_SCHEMA = _audit_schema({})
CONTROL_AUDIT_SCHEMA = _audit_schema({"expected_row_count": _LONG})


def with_corrupt_column(schema: StructType, name: str = CORRUPT_COLUMN) -> StructType:
    """The schema with the corrupt-record column at the end, added only when it is missing."""
    if name in schema.fieldNames():
        return schema
    return StructType([*schema.fields, StructField(name, StringType(), True)])


def load_schema(path: str, corrupt_column: str | None = None) -> StructType:
    """Read a schema stored as the YAML or JSON form of a ``StructType``."""
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith(".json"):
        content = json.loads(text)
    elif yaml is None:
        raise ImportError("reading a YAML schema needs PyYAML; store the schema as .json instead")
    else:
        content = yaml.safe_load(text)
    schema = StructType.fromJson(content)
    return with_corrupt_column(schema, corrupt_column) if corrupt_column else schema


def save_schema(schema: StructType, path: str) -> None:
    """Write a schema so that ``load_schema`` reads it back."""
    content = json.loads(schema.json())
    if path.endswith(".json"):
        text = json.dumps(content, indent=2)
    elif yaml is None:
        raise ImportError("writing a YAML schema needs PyYAML; use a .json path instead")
    else:
        text = yaml.safe_dump(content, indent=4)
    Path(path).write_text(text, encoding="utf-8")


def infer_schema(
    spark: SparkSession, path: str | list[str], fmt: str = "csv", options: dict | None = None
) -> StructType:
    """Infer a schema once from sample files, so that later loads can fix it."""
    chosen = {**(options or {})}
    if fmt == "csv":
        chosen.update(inferSchema=True, enforceSchema=False)
    return spark.read.format(fmt).options(**chosen).load(path).schema


def merge_hints(inferred: StructType, hints: StructType | str) -> StructType:
    """Replace the types of hinted columns; hinted columns not inferred go to the end."""
    wanted = StructType.fromDDL(hints) if isinstance(hints, str) else hints
    by_name = {f.name: f for f in wanted.fields}
    fields = [by_name.pop(f.name, f) for f in inferred.fields]
    return StructType(fields + list(by_name.values()))
