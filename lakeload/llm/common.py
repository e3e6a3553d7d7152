"""What several operators share: words, scratch tables, numbered copies, Arrow rows."""

from __future__ import annotations

import gc
import math
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.sinks.scratch import scratch_dir

#: Rows that a task works on at a time.
ROWS = 1024
#: A word: anything between ASCII white space. ``bytes.split()`` cuts UTF-8 text alike.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def short_batches(spark: SparkSession) -> None:
    """Pass ``ROWS`` rows to Python at once at most, in this session from now on.

    Texts are long: the usual 10,000 rows take much memory on both sides of the pipe.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= ROWS:
        spark.conf.set(name, ROWS)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts the lineage and fixes what was computed."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores in front as no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
    return out


def word_count(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def repeated(df: DataFrame, count: str, number: str, step: int = 4096) -> DataFrame:
    """Each row ``count`` times with ``number`` from 0; a large count is unfolded in two steps."""
    starts = F.expr(f"sequence(0L, greatest(`{count}` - 1, 0L), {step}L)")
    last = F.expr(f"least(_start + {step}L, `{count}`) - 1")
    return (
        df.filter(F.col(count) > 0)
        .withColumn("_start", F.explode(starts))
        .withColumn(number, F.explode(F.sequence(F.col("_start"), last)))
        .drop("_start")
    )


def levels(leaves: int, fan_in: int) -> int:
    """Passes until a tree with so many leaves has one root."""
    return 1 + (math.ceil(math.log(leaves, fan_in) - 1e-9) if leaves > 1 else 0)


def utf8(column: pa.Array) -> list[bytes | None]:
    """A text column as bytes."""
    return column.cast(pa.binary()).to_pylist()


@contextmanager
def uncollected():
    """Python's search for cycles rests, for work that makes very many objects and no cycles among them."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


class Remembered(dict):
    """A dict that makes what it misses. When full it becomes the older half, from which what is used returns.

    Keys longer than ``longest`` are made each time.
    """

    def __init__(self, make: Callable, most: int, longest: int):
        super().__init__()
        self.make, self.most, self.longest, self.older = make, most, longest, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > self.longest:
                return value
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


def per_batch(
    make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch | None]],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For ``mapInArrow``: ``make`` runs once in each task and gives the function over its batches.

    Batches are handed on ``ROWS`` rows at a time, so that what is made of them stays small.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = make()
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                out = each(batch.slice(first, ROWS))
                if out is not None and out.num_rows:
                    yield out

    return run
