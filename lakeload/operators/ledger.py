"""Which files are already loaded, and dropping their rows from a new load."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.sources.files import FILE_KEYS, as_written, list_files

# A ledger up to this many files is broadcast (about 50 MB of paths); a longer one is shuffled.
BROADCAST_FILES = 200_000
# New files are read by name, this many in a run at most; more files are more runs.
FILES_PER_RUN = 10_000
# Tasks that share the rows of one file when the list of files is too long to broadcast.
SALTS = 64


def file_ledger(raw: DataFrame, keys: list[str] = FILE_KEYS) -> DataFrame:
    """The files a raw table already holds, from its own rows: never out of step with the data."""
    return raw.select(*(f"_metadata.{k}" for k in keys)).distinct()


def audit_ledger(audit: DataFrame, source_table: str, keys: list[str] = FILE_KEYS) -> DataFrame:
    """The files an audit table records for one source table."""
    return audit.where(F.col("source_table") == source_table).select(*keys).distinct()


def _bounded(files: DataFrame) -> bool:
    """Whether a count shows that the list of files is small enough to broadcast."""
    return files.limit(BROADCAST_FILES + 1).count() <= BROADCAST_FILES


def _same_file(prefix: str, keys: list[str]) -> Column:
    return reduce(
        lambda a, b: a & b, (F.col(f"{prefix}{k}").eqNullSafe(F.col(f"_seen_{k}")) for k in keys)
    )


def _renamed(files: DataFrame, keys: list[str]) -> DataFrame:
    return files.select(*(F.col(k).alias(f"_seen_{k}") for k in keys)).distinct()


def _match_files(df: DataFrame, files: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Semi or anti join of rows with files: a broadcast when bounded.

    Otherwise the rows are shuffled with a salt from their input split, and each file is copied to
    every salt, so the rows of one large file spread over many tasks.
    """
    same = _same_file("_metadata.", keys)
    if _bounded(files):
        return df.join(F.broadcast(files), same, how)
    salted = df.withColumn("_salt", F.spark_partition_id() % SALTS)
    copies = files.withColumn("_file_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, same & (F.col("_salt") == F.col("_file_salt")), how).drop("_salt")


def skip_loaded(df: DataFrame, ledger: DataFrame, keys: list[str] = FILE_KEYS) -> DataFrame:
    """Rows of files not in the ledger; ``df`` may be a batch or a stream.

    The default key is path, name, size and modification time; ``["file_name",
    "file_modification_time"]`` is the looser key for files that move. Against a long ledger, a
    batch first finds its own new files, which are few as a rule, and keeps their rows.
    """
    seen = _renamed(ledger, keys)
    if df.isStreaming or _bounded(seen):
        return _match_files(df, seen, keys, "left_anti")
    present = df.select(*(F.col(f"_metadata.{k}").alias(k) for k in keys)).distinct()
    fresh = present.join(seen, _same_file("", keys), "left_anti")
    return _match_files(df, _renamed(fresh, keys), keys, "left_semi")


def without_files(ledger: DataFrame, files: DataFrame, keys: list[str] = FILE_KEYS) -> DataFrame:
    """The ledger without some files, as lists of files on both sides."""
    return ledger.select(*keys).join(_renamed(files, keys), _same_file("", keys), "left_anti")


def new_files(
    spark: SparkSession, path: str | list[str], ledger: DataFrame | None, keys: list[str] = FILE_KEYS
) -> DataFrame:
    """Listed files that the ledger does not hold; no file is opened."""
    listed = list_files(spark, path)
    if ledger is None:
        return listed
    return listed.join(_renamed(ledger, keys), _same_file("", keys), "left_anti")


def new_paths(
    spark: SparkSession, path: str | list[str], ledger: DataFrame | None, keys: list[str] = FILE_KEYS
) -> Iterator[list[str]]:
    """Names of the new files in order, in groups of ``FILES_PER_RUN`` at most; all of them, however many."""
    names = new_files(spark, path, ledger, keys).select("path").orderBy("path").toLocalIterator()
    while group := [as_written(r.path) for r in islice(names, FILES_PER_RUN)]:
        yield group
