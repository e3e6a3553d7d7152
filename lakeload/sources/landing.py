"""Reading landing files in batch and as an incremental stream, with one set of options."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lakeload.functions.dates import Timeslice
from lakeload.sources.schema import CORRUPT_COLUMN, with_corrupt_column

# The two CSV dialects of the landing files.
_COMMON_CSV = {
    "inferSchema": "false",
    "enforceSchema": "true",
    "columnNameOfCorruptRecord": CORRUPT_COLUMN,
    "mode": "PERMISSIVE",
    "escape": '"',
    "nullValue": "",
    "quote": '"',
    "emptyValue": "",
}
CONTROL_CSV = {**_COMMON_CSV, "header": "false", "delimiter": ",", "encoding": "windows-1252"}
DELIMITED_CSV = {**_COMMON_CSV, "header": "true", "delimiter": "|", "encoding": "utf-8"}

# The encodings Spark 4 reads without the legacy charset setting.
_BUILT_IN_ENCODINGS = {
    "US-ASCII", "ISO-8859-1", "UTF-8", "UTF-16BE", "UTF-16LE", "UTF-16", "UTF-32",
}
_JAVA_CHARSETS = "spark.sql.legacy.javaCharsets"


_REPLACED = re.compile(r"\{\{\s*table\.replace\(\s*'([^']*)'\s*,\s*'([^']*)'\s*\)\s*\}\}")


def landing_glob(
    template: str,
    table: str,
    timeslice: Timeslice | str = "*",
    path_date_format: str = "%Y%m%d",
    filename_date_format: str = "%Y%m%d",
) -> str:
    """Fill ``{{table}}``, ``{{path_date_format}}`` and ``{{filename_date_format}}`` in a path.

    ``{{table.replace('a','b')}}`` is the table's name with one string for another.
    """
    chosen = Timeslice.parse(timeslice) if isinstance(timeslice, str) else timeslice
    template = _REPLACED.sub(lambda m: table.replace(m[1], m[2]), template)
    return (
        template.replace("{{table}}", table)
        .replace("{{path_date_format}}", chosen.to_glob(path_date_format))
        .replace("{{filename_date_format}}", chosen.to_glob(filename_date_format))
    )


def _prepare(spark: SparkSession, schema: StructType | str, fmt: str, options: dict | None):
    options = {**(options or {})}
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if fmt in ("csv", "json"):
        options.setdefault("mode", "PERMISSIVE")
        if options["mode"].upper() == "PERMISSIVE":
            corrupt = options.setdefault("columnNameOfCorruptRecord", CORRUPT_COLUMN)
            schema = with_corrupt_column(schema, corrupt)
    encoding = options.get("encoding", "UTF-8").upper()
    if encoding not in _BUILT_IN_ENCODINGS and spark.conf.get(_JAVA_CHARSETS, "false") != "true":
        raise ValueError(
            f"encoding {encoding} needs {_JAVA_CHARSETS}=true in this session; "
            "set it before reading such files"
        )
    return schema, options


def read_landing(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str,
    fmt: str = "csv",
    options: dict | None = None,
) -> DataFrame:
    """Batch scan with a fixed schema. Malformed CSV or JSON lines keep their text.

    Which lines count as malformed depends on the columns a query reads, so write the rows out
    full width (``load_raw`` does) before filtering or counting on the corrupt column.
    """
    schema, options = _prepare(spark, schema, fmt, options)
    return spark.read.schema(schema).format(fmt).options(**options).load(path)


def stream_landing(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    fmt: str = "csv",
    options: dict | None = None,
) -> DataFrame:
    """The same scan as a stream: each file is read once per checkpoint.

    ``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` in ``options`` bound a micro-batch.
    """
    schema, options = _prepare(spark, schema, fmt, options)
    return spark.readStream.schema(schema).format(fmt).options(**options).load(path)
