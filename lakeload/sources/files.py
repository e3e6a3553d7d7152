"""File listings as DataFrames. Only names, sizes and times are read, never contents."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.functions.dates import Timeslice, directory_slice_date, slice_date_from
from lakeload.sinks.scratch import scratch_dir
from lakeload.sources.landing import landing_glob

# The columns that identify a loaded file.
FILE_KEYS = ["file_path", "file_name", "file_size", "file_modification_time"]


_LISTED = "file_path string, file_name string, file_size long, file_modification_time timestamp, path string"


def list_files(spark: SparkSession, path: str | list[str], pattern: str | None = None) -> DataFrame:
    """One row per file that is not empty: path, name, size and modification time, and ``path`` as it is
    written (``file_path`` is encoded like an address).

    The listing is one job with a task per core, however many bytes the files hold, and is kept in the scratch
    folder, so that what was listed stays the same while it is used.
    """
    # A session of its own: tasks over files are cut by bytes, and names have none.
    listing = spark.newSession()
    listing.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 60))
    target = scratch_dir(spark, "listing")
    _listing(listing, path, pattern).write.parquet(target)
    return spark.read.schema(_LISTED).parquet(target)


def _listing(spark: SparkSession, path: str | list[str], pattern: str | None = None) -> DataFrame:
    reader = spark.read.format("binaryFile")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if not _has_glob(path):
        reader = reader.option("recursiveFileLookup", "true")
    return reader.load(path).select(*(f"_metadata.{k}" for k in FILE_KEYS), "path")


def _has_glob(path: str | list[str]) -> bool:
    return any(c in p for p in ([path] if isinstance(path, str) else path) for c in "*?[]{}")


def same_reading(path: str | list[str], names: list[str] | None = None) -> dict[str, str]:
    """Reader options under which some files, read by name, have the columns that the whole path has.

    Below a plain directory the folders ``key=value`` are columns; where a path has glob characters they are
    not, and folders below what it matches are searched. Without names the options are for the path itself.
    """
    if _has_glob(path) or not isinstance(path, str):
        return {"recursiveFileLookup": "true"}
    one_file = not names or any(n.endswith(path) for n in names)
    return {} if one_file else {"basePath": path}


def as_written(path: str) -> str:
    """A file name in which no character has a meaning to a reader."""
    return re.sub(r"([*?\[\]{}\\])", r"\\\1", path)


def ready_slices(
    spark: SparkSession,
    directory: str,
    pattern: str = "*.flg",
    fmt: str = "%Y%m%d",
    from_directory: bool = False,
    timeslice: Timeslice | str = "*",
) -> DataFrame:
    """Slice dates whose flag file has arrived; semi-join a load on ``_slice_date``.

    Flag files are empty, and Spark plans no task for an empty file, so their names come from the
    listing itself: one name per finished slice. ``timeslice`` fills the date formats in ``directory`` and
    ``pattern`` as in ``landing_glob``, so that only the flags of the slices being loaded are listed.
    """
    pattern, directory = (landing_glob(p, "", timeslice, fmt, fmt) for p in (pattern, directory))
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern)
    paths = [(path,) for path in reader.load(directory).inputFiles()]
    files = spark.createDataFrame(paths, "path string")
    name = F.substring_index("path", "/", -1)
    if from_directory:
        date = directory_slice_date(F.col("path"), name, fmt)
    else:
        date = slice_date_from(name, fmt)
    dates = files.select(date.alias("_slice_date"))
    return dates.where(F.col("_slice_date").isNotNull()).distinct()
