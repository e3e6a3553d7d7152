"""End-to-end loads: landing to raw, control records, audit, base."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from lakeload.operators.audit import audit, enforce_thresholds
from lakeload.operators.cdc import apply_cdc, scd2
from lakeload.operators.control import header_footer, header_footer_stream
from lakeload.operators.feed import change_feed
from lakeload.operators.ledger import file_ledger, new_paths, skip_loaded, without_files
from lakeload.operators.skew import same_keys
from lakeload.operators.splice import Splicer
from lakeload.operators.stage import stage, valid_rows
from lakeload.sinks.scratch import scratch_dir
from lakeload.sinks.store import RUN, Store, run_name
from lakeload.sources.files import FILE_KEYS, same_reading
from lakeload.sources.landing import read_landing, stream_landing
from lakeload.sources.schema import AUDIT_SCHEMA, CONTROL_AUDIT_SCHEMA, HEADER_FOOTER_SCHEMA

#: Partition column of histories kept in buckets.
BUCKET = "_bucket"


def loaded_files(store: Store, name: str) -> DataFrame:
    """The files a raw table holds, kept in the table ``<name>_files``.

    Before it is used the ledger catches up with runs it does not know yet. Which these are is a matter of names:
    folders of the raw table, without those that the ledger's note says it covers. They reach the scan as values
    of its partition column, so only their files are opened, once each. The note holds how many rows each part of
    the ledger has and is written after the part; only whole parts count, so the ledger never misses a finished
    load, wherever an earlier job stopped. One job at a time may load a table.
    """
    ledger = f"{name}_files"
    notes = store.notes(ledger)
    parts = (notes.read("parts") or {}).get("parts", {})
    there = set(store.runs(ledger))
    if there:
        found = store.read_with_runs(ledger).groupBy(RUN).count().collect()  # a row for each load
        whole = {r[RUN] for r in found if r[RUN] in parts and r["count"] == parts[r[RUN]]["rows"]}
    parts = {p: told for p, told in parts.items() if there and p in whole or not told["rows"]}
    new = sorted(set(store.runs(name)) - {r for told in parts.values() for r in told["runs"]})
    if new or not parts:
        # Files whose rows have all expired are loaded files too.
        rows = store.read_with_runs(name, bounded=False).where(F.col(RUN).isin(new))
        lineage = rows.select(*(F.col(f"_metadata.{k}").alias(k) for k in FILE_KEYS), F.col(RUN).alias("run"))
        part = store.append(ledger, lineage.distinct())
        parts[part] = {"rows": store.read_run(ledger, part).count(), "runs": new}
        notes.write("parts", {"parts": parts})
        there.add(part)
    held = store.read_with_runs(ledger)
    if lost := sorted(there - set(parts)):
        held = held.where(~F.col(RUN).isin(lost))
    return held.select(*FILE_KEYS)


def _seen_by_others(
    store: Store, name: str, run: str, ledger: DataFrame, keys: list[str]
) -> DataFrame:
    """The ledger without the files of one run.

    A micro-batch that runs again after a failure replaces its own earlier rows, so it must bring
    those files again. As their directory is about to be replaced, the ledger is written out first.
    """
    if not store.exists(name):
        return ledger
    own = file_ledger(store.read_run(name, run), keys)
    if own.isEmpty():
        return ledger
    path = scratch_dir(store.spark, "ledger")
    without_files(ledger, own, keys).write.parquet(path)
    return store.spark.read.parquet(path)


def load_raw(
    store: Store,
    name: str,
    path: str,
    schema: StructType | str,
    process_id: int | None,
    mode: str = "batch",
    fmt: str = "csv",
    options: dict | None = None,
    drop_loaded: bool = True,
    ledger: DataFrame | None = None,
    ledger_keys: list[str] = FILE_KEYS,
    checkpoint: str | None = None,
    partition_by: dict[str, Column] | None = None,
    cluster_by: list[str] | None = None,
    load_date: Column | None = None,
    slice_format: str = "%Y%m%d",
    slice_from: str | None = "file",
    validity: bool = True,
    meta_first: bool = False,
) -> str | list[str] | None:
    """Load landing files into a raw table, leaving out files it already holds.

    The ledger of loaded files follows the raw table's own lineage unless another one is passed,
    so a failure between the load and its audit cannot load a file twice. In batch mode the
    listing is compared with the ledger first and only the new files are read, the first time as later; the
    name of the run is returned, or a list of them when there were very many files, or None when there was
    nothing new. Should the driver be lost while Spark moves a
    batch's finished files into place, remove that run's directory before loading again.
    """
    spark = store.spark

    def staged(df: DataFrame) -> DataFrame:
        return stage(
            df, process_id, slice_format, slice_from, meta_first, validity, load_date
        )

    if ledger is None and drop_loaded and store.exists(name):
        ledger = loaded_files(store, name)
    if not drop_loaded:
        ledger = None

    if mode == "stream":
        if checkpoint is None:
            raise ValueError("a stream load needs a checkpoint directory")

        def unseen(batch: DataFrame, run: str) -> DataFrame:
            seen = _seen_by_others(store, name, run, ledger, ledger_keys)
            return skip_loaded(batch, seen, ledger_keys)

        how = {**same_reading(path), **(options or {})}
        rows = staged(stream_landing(spark, path, schema, fmt, how))
        prepare = unseen if ledger is not None else None
        store.append_stream(name, rows, checkpoint, partition_by, cluster_by, prepare=prepare)
        return None
    if mode == "batch":
        runs = []
        for paths in new_paths(spark, path, ledger, ledger_keys):
            rows = read_landing(spark, paths, schema, fmt, {**same_reading(path, paths), **(options or {})})
            runs.append(store.append(name, staged(rows), None, partition_by, cluster_by))
        return runs if len(runs) > 1 else runs[0] if runs else None
    raise ValueError(f"mode must be 'batch' or 'stream', got {mode!r}")


def expire_raw(
    store: Store, name: str, days: int, as_of: dt.datetime | str | None = None, column: str = "_slice_date"
) -> list[str]:
    """Let old rows of a raw table stop counting; gives the runs that went. Their files are not loaded again:
    the ledger of loaded files takes note of them first."""
    loaded_files(store, name)
    return store.expire(name, days, as_of, column)


def copy_into(
    store: Store,
    name: str,
    path: str,
    schema: StructType | str,
    fmt: str = "csv",
    options: dict | None = None,
    ledger_keys: list[str] = FILE_KEYS,
) -> None:
    """Idempotent load of files as they are, with their ``_metadata``; known files are skipped.

    Columns that later files add are added to the table.
    """
    ledger = loaded_files(store, name) if store.exists(name) else None
    for paths in new_paths(store.spark, path, ledger, ledger_keys):
        rows = read_landing(store.spark, paths, schema, fmt, {**same_reading(path, paths), **(options or {})})
        store.append(name, rows.select("*", "_metadata"))


def _loaded(store: Store, raw: str, run: str | list[str] | None) -> DataFrame:
    return store.read(raw) if run is None else store.read_run(raw, run)


def load_header_footer(
    store: Store,
    raw: str,
    name: str,
    process_id: int,
    mode: str = "batch",
    checkpoint: str | None = None,
    watermark: str | None = None,
    run: str | None = None,
    state_partitions: int | None = None,
    raw_run: str | list[str] | None = None,
    how: str = "inner",
) -> None:
    """Extract the control records of a loaded process (batch) or of all new rows (stream).

    With the ``raw_run`` that ``load_raw`` returned only that run's files are opened. A file has
    two control records, so the join state of a stream needs few partitions.
    """
    store.ensure(name, HEADER_FOOTER_SCHEMA)
    if mode == "stream":
        rows = store.read_stream(raw)
        matched = header_footer_stream(rows, watermark, how)
        store.append_stream(name, matched, checkpoint, state_partitions=state_partitions)
    else:
        store.append(name, header_footer(_loaded(store, raw, raw_run), process_id, how), run)


def load_audit(
    store: Store,
    raw: str,
    name: str,
    process_id: int,
    source: tuple[str, str],
    target: tuple[str, str],
    warning: dict | None = None,
    exception: dict | None = None,
    header_footer_table: str | None = None,
    run: str | None = None,
    enforce: bool = False,
    grain: str = "file",
    raw_run: str | list[str] | None = None,
) -> DataFrame:
    """Append the audit of one process and return its rows.

    With ``enforce`` a breach of the exception thresholds raises, after the audit is stored. With
    the ``raw_run`` that ``load_raw`` returned only that run's files are opened.
    """
    control = store.read(header_footer_table) if header_footer_table else None
    store.ensure(name, CONTROL_AUDIT_SCHEMA if control is not None else AUDIT_SCHEMA)
    loaded = _loaded(store, raw, raw_run)
    rows = audit(loaded, process_id, source, target, warning, exception, control, grain=grain)
    stored = store.read_run(name, store.append(name, rows, run))
    if enforce:
        enforce_thresholds(stored)
    return stored


def create_control_tables(
    store: Store, audits: list[str], header_footer_table: str | None = None
) -> None:
    """Create the audit tables, and the control record table, before the first load."""
    schema = CONTROL_AUDIT_SCHEMA if header_footer_table else AUDIT_SCHEMA
    for name in audits:
        store.ensure(name, schema)
    if header_footer_table:
        store.ensure(header_footer_table, HEADER_FOOTER_SCHEMA)


def load_base(store: Store, raw: str, base: str) -> None:
    """The base table as the valid rows of raw; only files of runs that it has not taken are opened.

    Each run of raw is a run of base, so a load that stopped is made good by the next one. A note beside the base
    names the runs it has taken, those without a valid row too.
    """
    notes = store.notes(base)
    taken = (notes.read("taken") or {"runs": []})["runs"]
    new = sorted(set(store.runs(raw)) - set(taken))
    if not new:
        return
    rows = store.read_with_runs(raw).where(F.col(RUN).isin(new))
    store.append_derived(base, valid_rows(rows), new)
    notes.write("taken", {"runs": [*taken, *new]})


def _change_rows(
    store: Store, raw: str, used: list[str], runs: list[str] | None = None
) -> tuple[DataFrame, list[str]]:
    """The valid source rows of raw, or of some runs, with the system columns a sequence uses, and those columns."""
    rows = store.read(raw) if runs is None else store.read_with_runs(raw).where(F.col(RUN).isin(runs)).drop(RUN)
    if "_is_valid" in rows.columns:
        rows = valid_rows(rows)
    system = [c for c in used if c.startswith("_")]
    source = [c for c in rows.columns if not c.startswith("_")]
    return rows.select(*source, *system), system


def load_current(
    store: Store,
    raw: str,
    base: str,
    keys: list[str],
    sequence_by: list[str],
    op_column: str | None = None,
    except_cols: tuple[str, ...] = (),
) -> None:
    """The base table as the current row per key; ``sequence_by`` may name ``_slice_date``."""
    rows, system = _change_rows(store, raw, sequence_by)
    store.replace(
        base, apply_cdc(rows, keys, sequence_by, op_column, except_cols=(*except_cols, *system))
    )


def load_history(
    store: Store,
    raw: str,
    base: str,
    keys: list[str],
    sequence_by: str | list[str],
    except_cols: tuple[str, ...] = (),
    tie_cols: tuple[str, ...] = (),
    **how,
) -> None:
    """The base table as type 2 history of raw; other options as in ``scd2``."""
    sequence = [sequence_by] if isinstance(sequence_by, str) else list(sequence_by)
    rows, system = _change_rows(store, raw, [*sequence, *tie_cols])
    store.replace(
        base, scd2(rows, keys, sequence, (*except_cols, *system), tie_cols, **how)
    )


def splice_history(
    store: Store,
    raw: str,
    base: str,
    keys: list[str],
    sequence_by: str | list[str],
    except_cols: tuple[str, ...] = (),
    tie_cols: tuple[str, ...] = (),
    buckets: int = 64,
    **how,
) -> None:
    """Bring a type 2 history up to date with the runs of raw that it has not taken, in any order of time.

    The history is kept as spans in hash buckets of the key. Only buckets with a changed key are read and written;
    keys of such a bucket without a change go over as they are. One note names the runs taken and the run that holds each bucket, so
    a step counts as a whole or not at all, and readers see the old or the new state. The log is not read, but for
    keys with a change inside a span. Folders that neither this state nor the one before needs are deleted.
    A key's spans meet in one task, in a sort that spills.
    """
    notes = store.notes(base)
    state = notes.read("history") or {"buckets": buckets, "runs": [], "holds": {}, "before": []}
    new = sorted(set(store.runs(raw)) - set(state["runs"]))
    if not new:
        return
    sequence = [sequence_by] if isinstance(sequence_by, str) else list(sequence_by)
    rows, system = _change_rows(store, raw, [*sequence, *tie_cols], new)
    splicer = Splicer(keys, sequence, (*except_cols, *system), tie_cols, **how)
    place = F.pmod(F.xxhash64(*keys), F.lit(state["buckets"])).cast("int")
    touched = [r[0] for r in rows.select(place.alias("b")).distinct().collect()]  # at most one for each bucket
    old = _spans_of(store, base, {b: r for b, r in state["holds"].items() if int(b) in touched})
    spliced = splicer.splice(old, rows, lambda: _change_rows(store, raw, [*sequence, *tie_cols], [*state["runs"], *new])[0])
    if old is not None:
        own = rows.select(*keys).distinct()
        others = old.alias("s").join(own.alias("k"), same_keys("s", "k", keys), "left_anti")
        spliced = spliced.unionByName(others)
    run = run_name(None)
    bucketed = spliced.withColumn(BUCKET, place)
    target = f"{store.path(base)}/{RUN}={run}"
    bucketed.hint("rebalance", F.col(BUCKET)).write.format(store.fmt).partitionBy(BUCKET).save(target)
    holds = {**state["holds"], **{str(b): run for b in touched}}
    notes.write("history", {
        "buckets": state["buckets"], "runs": [*state["runs"], *new], "holds": holds,
        "before": sorted(set(state["holds"].values())), "schema": spliced.schema.jsonValue(), "output": splicer.output(rows),
    })
    notes.drop_runs(RUN, set(holds.values()) | set(state["holds"].values()))


def _spans_of(store: Store, base: str, holds: dict[str, str]) -> DataFrame | None:
    """The spans of some buckets, given the run that holds each; other folders are not opened."""
    if not holds:
        return None
    kept = StructType.fromJson(store.notes(base).read("history")["schema"])
    whole = StructType([*kept.fields, StructField(RUN, StringType()), StructField(BUCKET, IntegerType())])
    by_run: dict[str, list[int]] = {}
    for bucket, run in holds.items():
        by_run.setdefault(run, []).append(int(bucket))
    chosen = reduce(lambda a, b: a | b, ((F.col(RUN) == r) & F.col(BUCKET).isin(b) for r, b in by_run.items()))
    return store.spark.read.schema(whole).format(store.fmt).load(store.path(base)).where(chosen).drop(RUN, BUCKET)


def read_spliced(store: Store, base: str, keys: list[str], sequence_by: str | list[str]) -> DataFrame:
    """The versions of a history that ``splice_history`` keeps up."""
    state = store.notes(base).read("history")
    return Splicer(keys, sequence_by).versions(_spans_of(store, base, state["holds"]), state["output"])


def table_changes(store: Store, name: str, keys: list[str]) -> DataFrame:
    """The change feed of a table since before its last replacement; the runs appended after that are in it."""
    return change_feed(store.read_before(name), store.read_with_runs(name), keys, store.runs(name)[0], RUN)


def build_customers(
    details: list[DataFrame], preferences: DataFrame, key: str = "id"
) -> DataFrame:
    """Customers as the union of their detail tables, with preferences where there are any."""
    customers = details[0]
    for more in details[1:]:
        customers = customers.unionByName(more, allowMissingColumns=True)
    return customers.join(preferences, key, "left")
