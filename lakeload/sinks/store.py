"""Named tables under one root, as directories of a columnar format.

Each append goes to its own ``_load=<run>`` partition. Repeating a run replaces exactly that
partition, so a retried batch or a replayed micro-batch never doubles rows, and no directory is
the target of Spark's file sink, whose log would hide batch appends from readers.

A table keeps its schema beside its runs, in a note ``_schema``: the columns of all runs, merged by name
before a run with new ones is written. Every read uses it, so which columns a table has never depends on the
names or the order of its runs, and no file is opened for it. A column may widen from run to run; files of older
runs keep the narrow type and the Parquet reader widens what it reads. The same record names the runs that count, if
not all do, which makes a replacement visible at once or not at all. One job at a time may write a table.

Rules kept with a table (``constrain``) hold for every write. Its rows go to a hidden folder first, are checked there
once, and are moved into the table if all rules hold; else they stay aside and no reader, batch or stream, sees them.

Old rows stop counting by a bound (``expire``) that stands in the same record as the runs that count.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakeload.operators.quality import check_constraints, split_constraints
from lakeload.sinks.layout import cluster
from lakeload.sinks.notes import Notes
from lakeload.sinks.spans import bound_before, from_bound, spans
from lakeload.sinks.types import wider
from lakeload.streaming.run import query_id, run_available

RUN = "_load"


class BrokenRules(ValueError):
    """A write that breaks rules of its table; ``failed`` maps each broken rule to its number of rows."""

    def __init__(self, name: str, failed: dict[str, int], runs: list[str]):
        super().__init__(f"{name}: {', '.join(f'{rule} fails on {n} rows' for rule, n in failed.items())}")
        self.name, self.failed, self.runs = name, failed, runs


def merged_schema(old: StructType, new: StructType) -> StructType:
    """The columns of both, the old ones first; a column in both gets the type that holds the values of both."""
    kinds = {f.name: f.dataType for f in old.fields}
    for f in new.fields:
        kind = wider(kinds.get(f.name, f.dataType), f.dataType)
        if kind is None:
            raise ValueError(
                f"column {f.name} is {kinds[f.name].simpleString()}, not {f.dataType.simpleString()}"
            )
        kinds[f.name] = kind
    return StructType([StructField(name, kind, True) for name, kind in kinds.items()])


def _failures(rows: DataFrame, rules: dict[str, str]) -> dict[str, int]:
    """Broken rules with their numbers of rows, all counted in one pass."""
    report = check_constraints(rows, rules).where("failed_rows > 0").collect()  # a row for each rule
    return {r["constraint_name"]: r["failed_rows"] for r in report}


def run_name(run: str | None) -> str:
    """A run's directory name; it starts with a letter, so Spark reads it back as text."""
    run = run or uuid.uuid4().hex
    return run if run.startswith(("run-", "stream-")) else f"run-{run}"


class Store:
    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.fmt = fmt

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _load(self, reader, path: str, *absent: str) -> DataFrame | None:
        """What a reader finds at a path, or None if nothing is there."""
        try:
            return reader.load(path)
        except AnalysisException as e:
            if e.getCondition() in ("PATH_NOT_FOUND", *absent):
                return None
            raise

    def read_files(self, name: str, fmt: str | None = None) -> DataFrame | None:
        """Files below the root that are not a table of runs; None if there are none."""
        return self._load(self.spark.read.format(fmt or self.fmt), self.path(name), "UNABLE_TO_INFER_SCHEMA")

    def notes(self, name: str) -> Notes:
        return Notes(self.spark, self.path(name))

    def _record(self, name: str) -> dict | None:
        """What the newest record says: ``schema``, ``runs`` that count (None for all), and what ``expire`` adds:
        ``since``, the bound that rows must reach, and ``gone``, the runs whose files its next call deletes.
        """
        return self.notes(name).read("schema")

    def _keep(self, name: str, schema: StructType, runs: list[str] | None, before: list[str] | None = None) -> None:
        self.notes(name).write("schema", {"schema": schema.jsonValue(), "runs": runs, "before": before})

    def runs(self, name: str) -> list[str]:
        """The runs of a table that count, from its folders' names; no file is opened."""
        record, there = self._record(name), self.notes(name).runs(RUN)
        if record is None or record["runs"] is None:
            return there
        return [r for r in there if r in set(record["runs"])]

    def schema(self, name: str) -> StructType | None:
        """The columns of a table, or None if there is no such table."""
        if record := self._record(name):
            return StructType.fromJson(record["schema"])
        reader = self.spark.read.format(self.fmt).option("mergeSchema", "true")
        found = self._load(reader, self.path(name), "UNABLE_TO_INFER_SCHEMA")
        return found.drop(RUN).schema if found is not None else None

    def exists(self, name: str) -> bool:
        return self.schema(name) is not None

    def ensure(self, name: str, schema: StructType) -> None:
        """Create an empty table with this schema unless the table exists."""
        if not self.exists(name):
            self._keep(name, schema, None)
            empty = self.spark.createDataFrame([], schema)
            empty.write.format(self.fmt).mode("overwrite").save(f"{self.path(name)}/{RUN}=created")

    def append(
        self,
        name: str,
        df: DataFrame,
        run: str | None = None,
        partition_by: dict[str, Column] | None = None,
        cluster_by: list[str] | None = None,
    ) -> str:
        """Append the rows as one run and return the run's name; a repeated name replaces its rows.

        ``partition_by`` maps partition column names to expressions; the rows are rebalanced by
        them first, which splits a hot partition over tasks and packs small ones. ``cluster_by``
        range-sorts instead, within the partitions; several columns are interleaved. Rows of one run share their load time, so clustering by that column
        needs no work: every file of a run already has a single value.
        """
        run = run_name(run)
        parts = partition_by or {}
        order = [c for c in cluster_by or [] if c != "_load_date"]
        df = df.withColumns(parts) if parts else df
        if order:
            # The writer sorts by partition first, so that comes first here too.
            df = cluster(df, order, first=list(parts))
        elif parts:
            df = df.hint("rebalance", *(F.col(c) for c in parts))
        rules = self.rules(name)
        self._check_columns(rules, df)
        record = None if rules else self._admit(name, df.schema)
        folder = self._aside(name) if rules else self.path(name)
        df.write.format(self.fmt).mode("overwrite").partitionBy(*parts).save(f"{folder}/{RUN}={run}")
        if rules:
            self._enforce(name, rules, df.schema, [run])
            record = self._admit(name, df.schema)
            self.notes(name).move_runs(RUN, folder, [run])
        self._count(name, record, [run])
        return run

    def constrain(self, name: str, rules: dict[str, str]) -> None:
        """Keep rules, conditions by name, that all rows of a table must meet from now on.

        Rows that are there are checked first. A null result is a failure. No rules lift those there are.
        """
        if rules and self.exists(name):
            self._check_columns(rules, self.read(name))
            if failed := _failures(self.read(name), rules):
                raise BrokenRules(name, failed, self.runs(name))
        self.notes(name).write("rules", rules)

    def rules(self, name: str) -> dict[str, str]:
        return self.notes(name).read("rules") or {}

    def left_aside(self, name: str, run: str | list[str]) -> DataFrame:
        """Rows of refused runs that break rules, with the names of these in ``_failed``.

        They are kept until the run is written again.
        """
        runs = [run_name(r) for r in ([run] if isinstance(run, str) else run)]
        rows = self._read_aside(name, runs, self.spark.read.option("mergeSchema", "true"))
        if rows is None:
            raise ValueError(f"no rows of {name} are left aside for {', '.join(runs)}")
        return split_constraints(rows.drop(RUN), self.rules(name))[1]

    def _read_aside(self, name: str, runs: list[str], reader) -> DataFrame | None:
        """Rows of runs in the hidden folder; only these runs' folders are listed. None if there are none."""
        notes, folder = self.notes(name), self._aside(name)
        there = [f"{folder}/{n}" for n in notes.names(folder) if unquote(n) in {f"{RUN}={r}" for r in runs}]
        there = [p for p in there if notes.names(p)]
        return reader.format(self.fmt).option("basePath", folder).load(there) if there else None

    def _aside(self, name: str) -> str:
        return f"{self.path(name)}/_aside"

    def _check_columns(self, rules: dict[str, str], df: DataFrame) -> None:
        """Fail before anything is written if a rule cannot be computed, a column that it names being absent."""
        if rules:
            df.select(*(F.expr(rule) for rule in rules.values()))

    def _enforce(self, name: str, rules: dict[str, str], schema: StructType, runs: list[str]) -> None:
        full = StructType([*(f for f in schema.fields if f.name != RUN), StructField(RUN, StringType())])
        rows = self._read_aside(name, runs, self.spark.read.schema(full))
        if rows is not None and (failed := _failures(rows, rules)):
            raise BrokenRules(name, failed, runs)

    def _admit(self, name: str, new: StructType) -> dict:
        """Add the columns of a run to the table's schema, before its rows are written; gives the record."""
        record = self._record(name)
        old = StructType.fromJson(record["schema"]) if record else self.schema(name)
        schema = merged_schema(old or StructType(), new)
        if record is None or schema.jsonValue() != old.jsonValue():
            record = {**(record or {"runs": None, "before": None}), "schema": schema.jsonValue()}
            self.notes(name).write("schema", record)
        return record

    def _count(self, name: str, record: dict, runs: list[str]) -> None:
        """Let runs count that are written now, if the record says which ones do; what was known of them is not."""
        if (known := self.notes(name).read("spans")) and not known["runs"].keys().isdisjoint(runs):
            others = {r: ends for r, ends in known["runs"].items() if r not in runs}
            self.notes(name).write("spans", {**known, "runs": others})
        if record["runs"] is not None and not set(runs) <= set(record["runs"]):
            every = list(dict.fromkeys([*record["runs"], *runs]))
            self.notes(name).write("schema", {**record, "runs": every})

    def replace(self, name: str, df: DataFrame) -> None:
        """Write a derived table anew. Readers see the old rows until all new ones are there.

        The rows replaced are kept until the next replacement, for readers at work. A bound on their age is lifted.
        """
        record, run = self._record(name), run_name(None)
        kept, rules = record or {"runs": None, "before": None}, self.rules(name)
        self._check_columns(rules, df)
        folder = self._aside(name) if rules else self.path(name)
        df.write.format(self.fmt).mode("overwrite").save(f"{folder}/{RUN}={run}")
        if rules:
            self._enforce(name, rules, df.schema, [run])
            # The new run must not count before the record says so.
            if kept["runs"] is None and (old := self.schema(name)):
                kept = {**kept, "runs": self.runs(name), "schema": old.jsonValue()}
                self.notes(name).write("schema", kept)
            self.notes(name).move_runs(RUN, folder, [run])
        self._keep(name, df.schema, [run], kept["runs"])
        self._delete(name, kept.get("gone"), [run, *(kept["runs"] or [])])
        for old in kept["before"] or []:
            empty = self.spark.createDataFrame([], df.schema)
            empty.write.format(self.fmt).mode("overwrite").save(f"{self.path(name)}/{RUN}={old}")

    def expire(
        self, name: str, days: int, as_of: dt.datetime | str | None = None, column: str = "_slice_date"
    ) -> list[str]:
        """Let rows older than ``days`` before ``as_of``, by default the newest value of the column, stop counting.

        Gives the runs that hold no other rows. These are left out by name from now on and no scan opens them; in
        the runs that the bound cuts it is a condition of every read, pushed to the scan. As with ``retain``, rows
        without a value do not count. Each run's least and greatest value are found once, from that column alone,
        and noted, so a call opens only files of runs written since the last one. Files of runs that stopped
        counting are deleted by the next call; until then readers at work have theirs. The bound never moves back,
        holds for rows that come later too, and is lifted by ``replace``. Streams read what is appended, however old.
        """
        record, notes, runs = self._record(name), self.notes(name), self.runs(name)
        if record is None:
            raise ValueError(f"{name} is not a table of runs")
        kind = StructType.fromJson(record["schema"])[column].dataType
        since = record.get("since") or {"column": column, "value": None}
        if since["column"] != column:
            raise ValueError(f"rows of {name} expire by {since['column']}, not by {column}")
        sort = {"column": column, "type": kind.simpleString()}
        known = notes.read("spans")
        known = known["runs"] if known and sort.items() <= known.items() else {}
        known = {r: known[r] for r in runs if r in known}
        if new := sorted(set(runs) - set(known)):
            rows = self.read_with_runs(name, bounded=False).where(F.col(RUN).isin(new))
            found = spans(rows.select(column, RUN), column, RUN)
            known |= {r: found.get(r, [None, None]) for r in new}
            notes.write("spans", {**sort, "runs": known})
        newest = max((greatest for _, greatest in known.values() if greatest is not None), default=None)
        bound = bound_before(self.spark, newest, as_of, days, kind)
        if bound is None:
            return []
        if since["value"] is not None and since["type"] == sort["type"]:
            bound = max(bound, since["value"])
        gone = [r for r in runs if known[r][1] is None or known[r][1] < bound]
        stay = [r for r in runs if r not in set(gone)]
        notes.write("schema", {**record, "runs": stay, "since": {**sort, "value": bound}, "gone": gone})
        self._delete(name, record.get("gone"), runs)
        return gone

    def _delete(self, name: str, gone: list[str] | None, but: list[str]) -> None:
        """Delete the files of runs that stopped counting, but not of those that were written again."""
        if gone := set(gone or []) - set(but):
            notes = self.notes(name)
            notes.drop_runs(RUN, set(notes.runs(RUN)) - gone)

    def read_before(self, name: str) -> DataFrame:
        """The table as it was before its last replacement."""
        record = self._record(name)
        if not record or not record["before"]:
            raise ValueError(f"{name} has not been replaced")
        rows = self.spark.read.format(self.fmt).option("mergeSchema", "true").load(self.path(name))
        return rows.where(F.col(RUN).isin(record["before"])).drop(RUN)

    def append_derived(self, name: str, df: DataFrame, runs: list[str]) -> None:
        """Append rows that carry their run in ``_load``, one of ``runs``; runs that are there are replaced."""
        rules = self.rules(name)
        self._check_columns(rules, df)
        record = None if rules else self._admit(name, df.drop(RUN).schema)
        folder = self._aside(name) if rules else self.path(name)
        df.write.format(self.fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RUN).save(
            folder
        )
        if rules:
            self._enforce(name, rules, df.schema, runs)
            record = self._admit(name, df.drop(RUN).schema)
            self.notes(name).move_runs(RUN, folder, runs)
        self._count(name, record, runs)

    def read(self, name: str, schema: StructType | None = None) -> DataFrame:
        """The whole table with the columns of all its runs, or those of ``schema``."""
        return self.read_with_runs(name, schema).drop(RUN)

    def read_with_runs(self, name: str, schema: StructType | None = None, bounded: bool = True) -> DataFrame:
        """The whole table with its run in ``_load``; conditions on it choose directories.

        ``bounded=False`` gives expired rows of runs that count as well.
        """
        record, reader = self._record(name), self.spark.read.format(self.fmt)
        if schema is None and record:
            schema = StructType.fromJson(record["schema"])
        if schema is not None:
            reader = reader.schema(StructType([*schema.fields, StructField(RUN, StringType())]))
        else:
            reader = reader.option("mergeSchema", "true")
        rows = reader.load(self.path(name))
        if not record or record["runs"] is None:
            return rows
        rows = rows.where(F.col(RUN).isin(record["runs"]))
        since = record.get("since") if bounded else None
        return from_bound(rows, since["column"], since["value"], since["type"]) if since else rows

    def read_run(self, name: str, run: str | list[str]) -> DataFrame:
        """The rows of one run, or of some; files of other runs are not opened."""
        runs = [run_name(r) for r in ([run] if isinstance(run, str) else run)]
        return self.read_with_runs(name).where(F.col(RUN).isin(runs)).drop(RUN)

    def read_stream(self, name: str, schema: StructType | None = None, **options: str) -> DataFrame:
        """Rows appended since the checkpoint: on an append-only table these are its inserts."""
        schema = schema or self.schema(name)
        full = schema if RUN in schema.fieldNames() else StructType([*schema.fields, StructField(RUN, StringType())])
        reader = self.spark.readStream.schema(full).format(self.fmt).options(**options)
        return reader.load(self.path(name)).drop(RUN)

    def append_stream(
        self,
        name: str,
        stream: DataFrame,
        checkpoint: str,
        partition_by: dict[str, Column] | None = None,
        cluster_by: list[str] | None = None,
        state_partitions: int | None = None,
        prepare: Callable[[DataFrame, str], DataFrame] | None = None,
    ) -> None:
        """Append everything available, one run per micro-batch, and wait for the end.

        ``prepare`` gets each micro-batch and its run, and gives the rows to append. A micro-batch that comes
        again after its run was finished is left out, so its files stay and no reader sees them twice.
        """

        def write(batch: DataFrame, batch_id: int) -> None:
            run = f"stream-{query_id(batch)}-{batch_id}"
            done = f"{self.path(name)}/_done/{RUN}={run}"
            finished = self._load(self.spark.read.format("text"), done)
            if finished is not None and not finished.isEmpty():
                return
            rows = prepare(batch, run) if prepare else batch
            self.append(name, rows, run, partition_by, cluster_by)
            self.spark.createDataFrame([("done",)], "value string").coalesce(1).write.mode("overwrite").text(done)

        writer = stream.writeStream.foreachBatch(write)
        run_available(self.spark, writer, checkpoint, state_partitions)

    def view(self, name: str, view: str | None = None) -> DataFrame:
        """Register the table as a temporary view for SQL."""
        df = self.read(name)
        df.createOrReplaceTempView(view or name)
        return df
