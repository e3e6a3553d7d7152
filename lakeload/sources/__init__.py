"""Landing files: schemas, batch and stream readers, file listings."""

from lakeload.sources.files import FILE_KEYS, list_files, ready_slices
from lakeload.sources.landing import (
    CONTROL_CSV,
    DELIMITED_CSV,
    landing_glob,
    read_landing,
    stream_landing,
)
from lakeload.sources.schema import (
    AUDIT_SCHEMA,
    CONTROL_AUDIT_SCHEMA,
    FOOTER_DDL,
    HEADER_DDL,
    HEADER_FOOTER_SCHEMA,
    METADATA_SCHEMA,
    infer_schema,
    load_schema,
    merge_hints,
    save_schema,
    with_corrupt_column,
)

__all__ = [
    "AUDIT_SCHEMA", "CONTROL_AUDIT_SCHEMA", "CONTROL_CSV", "DELIMITED_CSV", "FILE_KEYS",
    "FOOTER_DDL", "HEADER_DDL", "HEADER_FOOTER_SCHEMA", "METADATA_SCHEMA", "infer_schema",
    "landing_glob", "list_files", "load_schema", "merge_hints", "read_landing", "ready_slices",
    "save_schema", "stream_landing", "with_corrupt_column",
]
