"""The registered queries: one per operator, over the driver's tables, each with its ANSI SQL.

Landing files are derived from the tables: ``events`` becomes CSV lines by day, in which error
events carry text where a number is due, so they are malformed; ``orders`` becomes files by month.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampType

from lakeload.functions.scalar import hash_value, row_hash
from lakeload.operators.audit import audit, evaluate_thresholds, merge_thresholds, reconcile
from lakeload.operators.cdc import END, START, apply_cdc, as_of, history, scd2, unsequenced
from lakeload.operators.control import header_footer, parse_control
from lakeload.operators.ledger import audit_ledger, skip_loaded
from lakeload.operators.quality import (
    check_constraints,
    check_unique,
    distinct_rows,
    duplicate_keys,
    split_constraints,
)
from lakeload.operators.stage import inserted_rows, quarantine, retain, stage, valid_rows
from lakeload.plans.jobs import (
    build_customers,
    copy_into,
    load_audit,
    load_base,
    load_current,
    load_header_footer,
    load_history,
    load_raw,
    read_spliced,
    splice_history,
    table_changes,
)
from lakeload.sinks.scratch import scratch_dir
from lakeload.sinks.store import BrokenRules, Store
from lakeload.sources.files import ready_slices
from lakeload.sources.landing import CONTROL_CSV, DELIMITED_CSV, landing_glob, read_landing
from lakeload.sources.schema import infer_schema, load_schema, merge_hints, save_schema
from lakeload.streaming.history import read_history, stream_scd2

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        def wall_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
            """Timestamps as the wall clock of the session, which is what the SQL sees."""
            df = run(spark, sf_dir)
            return df.select(*(
                F.col(f.name).cast("timestamp_ntz").alias(f.name)
                if isinstance(f.dataType, TimestampType) else F.col(f.name)
                for f in df.schema.fields
            ))

        QUERIES[run.__name__] = wall_clock
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_store(spark: SparkSession, name: str) -> Store:
    return Store(spark, scratch_dir(spark, name))


# ---------------------------------------------------------------------------------------------
# Landing data derived from the tables

EVENT_DDL = "event_id long, ts timestamp, user_id long, event_type string, value double"
CONTROL_DDL = (
    "flag string, period timestamp, event_id long, user_id long, event_type string, value double"
)
ORDER_DDL = (
    "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp, o_orderpriority string"
)
CUSTOMER_DDL = (
    "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
)
SOURCE, TARGET = ("landing", "events"), ("raw", "events")

_VALUE = "if(event_type = 'error', 'unreadable', cast(value as string))"


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(day, line): one CSV line per event."""
    return table(spark, sf_dir, "events").select(
        F.date_format("ts", "yyyyMMdd").alias("day"),
        F.concat_ws(",", "event_id", F.col("ts").cast("string"), "user_id", "event_type", F.expr(_VALUE))
        .alias("line"),
    )


def control_lines(spark: SparkSession, sf_dir: str, complete: bool = True) -> DataFrame:
    """(day, line) of files with a header and a footer around the body.

    A header states the readable rows up to 23:55, so later rows break its count. Unless ``complete``, a
    day whose last event is before 23:55 has no footer yet, and every third day has lost its header.
    """
    events = table(spark, sf_dir, "events")
    day = F.date_format("ts", "yyyyMMdd").alias("day")
    late = F.date_format("ts", "HH:mm") >= "23:55"
    body = events.select(
        day,
        F.concat_ws(
            ",", F.lit('"I"'), F.col("ts").cast("string"), "event_id", "user_id", "event_type", F.expr(_VALUE)
        ).alias("line"),
    )
    days = events.groupBy(day).agg(
        F.count_if((F.col("event_type") != "error") & ~late).alias("stated"),
        F.date_format(F.min("ts"), "yyyyMMddHHmmss").alias("opened"),
        F.date_format(F.max("ts"), "yyyyMMddHHmmss").alias("closed"),
        F.max(late).alias("complete"),
    )
    opened = days if complete else days.where("cast(day as int) % 3 <> 0")
    header = opened.select(
        "day",
        F.concat_ws(",", F.lit('"H"'), "stated", "opened", F.concat(F.lit("batch"), "day")).alias("line"),
    )
    closed = days if complete else days.where("complete")
    footer = closed.select("day", F.concat_ws(",", F.lit('"F"'), F.lit("events"), "closed").alias("line"))
    return header.unionByName(body).unionByName(footer)


def parsed(lines: DataFrame, ddl: str) -> DataFrame:
    """Lines parsed in permissive mode, with the lineage of one file per day."""
    name = F.concat(F.lit("events-"), "day", F.lit(".csv"))
    unknown = F.lit(None).cast("long")
    lineage = F.struct(
        F.concat(F.lit("landing/events/"), "day", F.lit("/"), name).alias("file_path"),
        name.alias("file_name"),
        unknown.alias("file_size"),
        unknown.alias("file_block_start"),
        unknown.alias("file_block_length"),
        F.to_timestamp("day", "yyyyMMdd").alias("file_modification_time"),
    )
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}
    row = F.from_csv("line", f"{ddl}, _corrupt_record string", options)
    return lines.select(row.alias("row"), lineage.alias("_metadata")).select("row.*", "_metadata")


def raw_events(spark: SparkSession, sf_dir: str, **how) -> DataFrame:
    return stage(parsed(event_lines(spark, sf_dir), EVENT_DDL), 1, **how)


def raw_control(spark: SparkSession, sf_dir: str, complete: bool = True) -> DataFrame:
    return stage(parsed(control_lines(spark, sf_dir, complete), CONTROL_DDL), 1)


def land(df: DataFrame, directory: str, slices: str, date_format: str, on: str, fmt: str = "csv",
         **options: str) -> str:
    """Write rows as landing files under ``directory/<slices>=<date>/``; give the path template."""
    (
        df.withColumn(slices, F.date_format(on, date_format))
        .hint("rebalance", F.col(slices))
        .write.format(fmt).options(**options).partitionBy(slices).save(directory)
    )
    return directory + "/{{table}}={{path_date_format}}/*." + fmt


def land_orders(spark: SparkSession, sf_dir: str, store: Store) -> str:
    """Orders as pipe-delimited CSV by month; the order date is kept as text in full."""
    orders = table(spark, sf_dir, "orders")
    return land(
        orders, store.path("landing"), "orders", "yyyyMM", "o_orderdate",
        header="true", delimiter="|", timestampNTZFormat="yyyy-MM-dd HH:mm:ss",
    )


def land_events(spark: SparkSession, sf_dir: str, store: Store) -> str:
    """Event lines by day, as text."""
    directory = store.path("landing")
    lines = event_lines(spark, sf_dir).withColumnRenamed("day", "events")
    lines.hint("rebalance", F.col("events")).write.partitionBy("events").text(directory)
    return directory + "/{{table}}={{path_date_format}}/*.txt"


EVENTS_CSV = {"header": "false", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}

# ---------------------------------------------------------------------------------------------
# Staging

_STAGED = [
    "event_id", "ts", "user_id", "event_type", "value", "_corrupt_record", "_is_valid",
    "_slice_date", "_process_id",
]
_STAGED_SQL = """
    event_id, ts, user_id, event_type,
    case when event_type <> 'error' then value end as value,
    case when event_type = 'error' then concat_ws(',', event_id, ts, user_id, event_type, 'unreadable')
    end as _corrupt_record,
    event_type <> 'error' as _is_valid,
    cast(date_trunc('day', ts) as timestamp) as _slice_date,
    cast(1 as bigint) as _process_id
"""
_FILE_SQL = "'events-' || strftime(ts, '%Y%m%d') || '.csv' as file_name"


@query(f"select {_STAGED_SQL}, {_FILE_SQL} from events")
def stage_events(spark, sf_dir):
    return raw_events(spark, sf_dir).select(*_STAGED, "_metadata.file_name")


@query(f"select {_STAGED_SQL}, {_FILE_SQL} from events")
def stage_events_meta_first(spark, sf_dir):
    raw = raw_events(spark, sf_dir, meta_first=True, slice_from="path")
    return raw.select("_is_valid", "_slice_date", "_process_id", "_metadata.file_name", *_STAGED[:6])


@query(
    "select event_id, ts, user_id, event_type, "
    "case when event_type <> 'error' then value end as value, "
    "cast(date_trunc('day', ts) as timestamp) as _slice_date from events"
)
def stage_events_plain(spark, sf_dir):
    """Without process id and validity columns."""
    raw = stage(parsed(event_lines(spark, sf_dir), EVENT_DDL), None, validity=False)
    return raw.select(*_STAGED[:5], "_slice_date")


@query(f"select {_STAGED_SQL} from events where event_type <> 'error'")
def valid_rows_events(spark, sf_dir):
    return valid_rows(raw_events(spark, sf_dir)).select(*_STAGED)


@query(f"select {_STAGED_SQL} from events where event_type = 'error'")
def quarantine_events(spark, sf_dir):
    return quarantine(raw_events(spark, sf_dir)).select(*_STAGED)


@query("select * from events where ts >= (select max(ts) from events) - interval 7 day")
def retention(spark, sf_dir):
    return retain(table(spark, sf_dir, "events"), 7, column="ts")


@query("""
    with newest as (select max(o_orderdate) as day from orders)
    select o_orderkey, o_orderdate, o_totalprice from orders, newest where o_orderdate >= day - interval 800 days
""")
def retention_stored(spark, sf_dir):
    """Orders stored by year; first those of all years but the last expire, then the last year comes."""
    store = new_store(spark, "retention")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    year, last = F.year("o_orderdate"), orders.agg(F.max(F.year("o_orderdate"))).first()[0]
    years = [f"run-{y}" for y in range(last - 10, last)]
    earlier = orders.where(year < last).withColumn("_load", F.concat(F.lit("run-"), year.cast("string")))
    store.append_derived("orders", earlier, years)
    store.expire("orders", 800, column="o_orderdate")
    store.append("orders", orders.where(year == last), str(last))
    store.expire("orders", 800, column="o_orderdate")
    return store.read("orders")


@query("""
    select c_custkey, sha256(concat_ws('|', c_custkey, c_name, c_nationkey, c_mktsegment)) as row_hash,
           sha256(c_name) as name_hash
    from customer
""")
def row_hash_customer(spark, sf_dir):
    columns = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        row_hash(columns, separator="|").alias("row_hash"),
        hash_value(F.col("c_name"), 256).alias("name_hash"),
    )


# ---------------------------------------------------------------------------------------------
# Header and footer records

_DAYS_SQL = """
    select strftime(ts, '%Y%m%d') as day, cast(date_trunc('day', ts) as timestamp) as _slice_date,
           count(*) filter (where event_type <> 'error' and strftime(ts, '%H:%M') < '23:55') as stated,
           strftime(min(ts), '%Y%m%d%H%M%S') as opened,
           strftime(max(ts), '%Y%m%d%H%M%S') as closed,
           bool_or(strftime(ts, '%H:%M') >= '23:55') as complete,
           count(*) as body,
           count(*) filter (where event_type <> 'error') as readable
    from events group by 1, 2
"""
_HEADER_SQL = """
    'events-' || day || '.csv' as file_name, stated as row_count,
    cast(opened as bigint) as period, 'batch' || day as batch,
    '"H",' || stated || ',' || opened || ',batch' || day as raw_header
"""
_FOOTER_SQL = """
    'events' as footer_name, cast(closed as bigint) as footer_period,
    '"F",events,' || closed as raw_footer
"""
_CONTROL = [
    "file_name", "header.row_count", "header.period", "header.batch", "raw_header",
    "footer.name as footer_name", "footer.period as footer_period", "raw_footer", "_slice_date", "_process_id",
]


@query(f"with d as ({_DAYS_SQL}) select {_HEADER_SQL} from d")
def control_parse(spark, sf_dir):
    headers = parse_control(raw_control(spark, sf_dir), "header", 1)
    return headers.selectExpr(*_CONTROL[:5])


_MATCHED_SQL = f"""
    with d as ({_DAYS_SQL})
    select {_HEADER_SQL}, {_FOOTER_SQL}, _slice_date, cast(1 as bigint) as _process_id from d
"""


@query(_MATCHED_SQL)
def header_footer_batch(spark, sf_dir):
    return header_footer(raw_control(spark, sf_dir), 1).selectExpr(*_CONTROL)


@query(f"""
    with d as ({_DAYS_SQL})
    select 'events-' || day || '.csv' as file_name, cast(day as int) % 3 <> 0 as has_header,
           complete as has_footer, _slice_date
    from d where cast(day as int) % 3 <> 0 or complete
""")
def header_footer_missing(spark, sf_dir):
    """Files of which one control record is missing show up in the full match."""
    matched = header_footer(raw_control(spark, sf_dir, complete=False), 1, how="full")
    return matched.select(
        "file_name",
        F.col("raw_header").isNotNull().alias("has_header"),
        F.col("raw_footer").isNotNull().alias("has_footer"),
        "_slice_date",
    )


@query(_MATCHED_SQL)
def header_footer_streamed(spark, sf_dir):
    """The match as a stream-stream join over the stored raw table."""
    store = new_store(spark, "control")
    store.append("raw", raw_control(spark, sf_dir))
    load_header_footer(
        store, "raw", "header_footer", 1, "stream", store.path("checkpoint"), "1 day",
        state_partitions=4,
    )
    return store.read("header_footer").selectExpr(*_CONTROL)


@query(f"""
    with d as ({_DAYS_SQL})
    select 'events-' || day || '.csv' as file_name, cast(day as int) % 3 <> 0 as has_header,
           complete as has_footer, _slice_date
    from d where cast(day as int) % 3 <> 0 or complete
""")
def header_footer_missing_streamed(spark, sf_dir):
    """The full match as a stream: files of which one record is missing come out when their delay has passed."""
    store = new_store(spark, "late")
    loads = ((1, "2024-01-01", False), (2, "2024-01-09", True))
    for process, day, complete in loads:  # the second load only lets the time of the first one pass
        raw = raw_control(spark, sf_dir, complete=complete).withColumn("_load_date", F.lit(day).cast("timestamp"))
        store.append("raw", raw.withColumn("_process_id", F.lit(process).cast("long")))
        load_header_footer(
            store, "raw", "matched", process, "stream", store.path("checkpoint"), "2 days", state_partitions=4, how="full"
        )
    return store.read("matched").where("_process_id = 1").select(
        "file_name",
        F.col("raw_header").isNotNull().alias("has_header"),
        F.col("raw_footer").isNotNull().alias("has_footer"),
        "_slice_date",
    )


# ---------------------------------------------------------------------------------------------
# Audits

_AUDIT = [
    "file_name", "source_database", "source_table", "database", "table",
    "total_count", "valid_count", "invalid_count",
    "round(invalid_ratio, 6) as invalid_ratio", "_slice_date", "_process_id",
]
_AUDIT_SQL = """
    'events-' || strftime(ts, '%Y%m%d') || '.csv' as file_name,
    'landing' as source_database, 'events' as source_table, 'raw' as "database", 'events' as "table",
    count(*) as total_count,
    count(*) filter (where event_type <> 'error') as valid_count,
    count(*) filter (where event_type = 'error') as invalid_count,
    round(count(*) filter (where event_type = 'error') / count(*), 6) as invalid_ratio,
    cast(date_trunc('day', ts) as timestamp) as _slice_date,
"""


@query(f"select {_AUDIT_SQL} cast(1 as bigint) as _process_id from events group by all")
def audit_events(spark, sf_dir):
    return audit(raw_events(spark, sf_dir), 1, SOURCE, TARGET).selectExpr(*_AUDIT)


@query(f"""
    with d as ({_DAYS_SQL})
    select 'events-' || day || '.csv' as file_name, body + 2 as total_count,
           readable as valid_count, body + 2 - readable as invalid_count,
           round((body + 2 - readable) / (body + 2), 6) as invalid_ratio,
           stated as expected_row_count, readable = stated as is_reconciled,
           _slice_date, cast(1 as bigint) as _process_id
    from d
""")
def audit_expected(spark, sf_dir):
    raw = raw_control(spark, sf_dir)
    audited = audit(raw, 1, SOURCE, TARGET, header_footer=header_footer(raw, 1))
    return reconcile(audited).selectExpr(
        "file_name", *_AUDIT[5:9], "expected_row_count", "is_reconciled", "_slice_date", "_process_id"
    )


_WARNING = {"invalid_ratio": 0.2, "max_rows": 1_000_000_000}
_EXCEPTION = merge_thresholds({"invalid_ratio": 0.5, "min_rows": 1}, {"invalid_ratio": 0.21})


@query(f"""
    with a as (select {_AUDIT_SQL} cast(1 as bigint) as _process_id,
               count(*) filter (where event_type = 'error') / count(*) as ratio
               from events group by all)
    select file_name, total_count, valid_count, invalid_count, invalid_ratio,
           0.2::double as warning_invalid_ratio, 0.21::double as exception_invalid_ratio,
           cast(1 as bigint) as exception_min_rows,
           case when ratio > 0.21::double or total_count < 1 then 'exception'
                when ratio > 0.2::double or total_count > 1000000000 then 'warning'
                else 'ok' end as status
    from a
""")
def thresholds_status(spark, sf_dir):
    audited = audit(raw_events(spark, sf_dir), 1, SOURCE, TARGET, _WARNING, _EXCEPTION)
    return evaluate_thresholds(audited).selectExpr(
        "file_name",
        *_AUDIT[5:9],
        "warning_thresholds.invalid_ratio as warning_invalid_ratio",
        "exception_thresholds.invalid_ratio as exception_invalid_ratio",
        "exception_thresholds.min_rows as exception_min_rows",
        "status",
    )


@query(f"""
    with e as (select *, case when ts < timestamp '2024-01-16' then 1 else 2 end as p from events),
    a as (select {_AUDIT_SQL} cast(p as bigint) as _process_id from e group by p, all)
    select a.*, cast(1 as bigint) as files_in_ledger from a
""".replace("group by p, all", "group by all"))
def audit_append_ledger(spark, sf_dir):
    """Two processes load and audit; the audit table then serves as ledger of loaded files."""
    store = new_store(spark, "audit")
    raw = raw_events(spark, sf_dir)
    second = F.col("_slice_date") >= F.lit("2024-01-16").cast("timestamp")
    for process_id, part in ((1, raw.where(~second)), (2, raw.where(second))):
        store.append("raw", part.withColumn("_process_id", F.lit(process_id).cast("long")))
        load_audit(store, "raw", "audit", process_id, SOURCE, TARGET)
    audited = store.read("audit")
    ledger = audit_ledger(audited, "events", ["file_name"])
    per_file = ledger.groupBy("file_name").agg(F.count(F.lit(1)).alias("files_in_ledger"))
    return audited.join(per_file, "file_name").selectExpr(*_AUDIT, "files_in_ledger")


@query(f"""
    with d as ({_DAYS_SQL})
    select 'events-' || day || '.csv' as file_name, body + 2 as total_count,
           readable as valid_count, stated as expected_row_count, readable = stated as is_reconciled
    from d
""")
def control_load(spark, sf_dir):
    """Raw, control records and audit through stored tables, one after the other."""
    store = new_store(spark, "control-load")
    store.append("raw", raw_control(spark, sf_dir))
    load_header_footer(store, "raw", "header_footer", 1)
    audited = load_audit(
        store, "raw", "audit", 1, SOURCE, TARGET, exception={"invalid_rows": 2, "min_rows": 1},
        header_footer_table="header_footer",
    )
    return reconcile(audited).select(
        "file_name", "total_count", "valid_count", "expected_row_count", "is_reconciled"
    )


# ---------------------------------------------------------------------------------------------
# Landing files, ledgers, loads

_ORDERS_SQL = "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority from orders"
_ORDERS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _with_month_file(orders: DataFrame) -> DataFrame:
    month = F.date_format("o_orderdate", "yyyyMM")
    name = F.concat(F.lit("orders-"), month, F.lit(".csv"))
    return orders.withColumn("_metadata", F.struct(
        F.concat(F.lit("landing/orders/"), name).alias("file_path"),
        name.alias("file_name"),
        F.lit(None).cast("long").alias("file_size"),
        F.to_timestamp(month, "yyyyMM").alias("file_modification_time"),
    ))


@query("""
    select * from orders o where not exists (
        select 1 from orders old
        where old.o_orderdate < timestamp '1997-01-01'
          and date_trunc('month', old.o_orderdate) = date_trunc('month', o.o_orderdate))
""")
def skip_loaded_batch(spark, sf_dir):
    orders = _with_month_file(table(spark, sf_dir, "orders"))
    loaded = orders.where(F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp_ntz"))
    return skip_loaded(orders, loaded.select("_metadata.*")).select(*_ORDERS)


@query(f"{_ORDERS_SQL} where month(o_orderdate) > 6")
def skip_loaded_stream(spark, sf_dir):
    """The first half of each year is loaded in two batches, then a stream over all files adds the others."""
    store = new_store(spark, "ledger")
    template = land_orders(spark, sf_dir, store)
    how = {"options": DELIMITED_CSV, "slice_from": "path", "slice_format": "%Y%m"}
    for months in ("0[1-3]", "0[4-6]"):
        some = template.replace("{{table}}", "orders").replace("{{path_date_format}}", f"????{months}")
        load_raw(store, "raw", some, ORDER_DDL, 1, **how)
    load_raw(
        store, "raw", landing_glob(template, "orders", "*", "%Y%m"), ORDER_DDL, 2,
        mode="stream", checkpoint=store.path("checkpoint"), **how,
    )
    return store.read("raw").where("_process_id = 2").select(*_ORDERS)


@query(_ORDERS_SQL)
def copy_into_twice(spark, sf_dir):
    store = new_store(spark, "copy")
    path = landing_glob(land_orders(spark, sf_dir, store), "orders", "*", "%Y%m")
    for _ in range(2):
        copy_into(store, "orders", path, ORDER_DDL, options=DELIMITED_CSV)
    return store.read("orders").select(*_ORDERS)


@query("select *, true as _is_valid from customer")
def csv_roundtrip(spark, sf_dir):
    store = new_store(spark, "csv")
    landing = store.path("landing")
    table(spark, sf_dir, "customer").write.options(header="true", delimiter="|").csv(landing)
    load_raw(store, "raw", landing, CUSTOMER_DDL, 1, options=DELIMITED_CSV, slice_from=None)
    columns = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    return store.read("raw").select(*columns, "_is_valid")


@query(f"{_ORDERS_SQL} where o_orderdate >= timestamp '1998-01-01' and o_orderdate < timestamp '1999-01-01'")
def timeslice_year(spark, sf_dir):
    """Only the directories of the slice are listed and read."""
    store = new_store(spark, "slice")
    path = landing_glob(land_orders(spark, sf_dir, store), "orders", "1998-*-*", "%Y%m")
    return read_landing(spark, path, ORDER_DDL, options=DELIMITED_CSV).select(*_ORDERS)


@query("""
    with d as (select cast(date_trunc('day', ts) as timestamp) as _slice_date,
                      bool_or(strftime(ts, '%H:%M') >= '23:55') as complete from events group by 1)
    select event_id, ts, event_type, _slice_date
    from events join d on cast(date_trunc('day', ts) as timestamp) = _slice_date where complete
""")
def ready_slices_events(spark, sf_dir):
    """Only days whose flag file exists are taken; a day with events after 23:55 gets its flag."""
    store = new_store(spark, "flags")
    raw = raw_events(spark, sf_dir)
    done = raw.where(F.date_format("ts", "HH:mm") >= "23:55")
    flags = done.select(F.date_format("_slice_date", "yyyyMMdd").alias("ready")).distinct()
    flags.select("ready", F.lit("done").alias("value")).write.partitionBy("ready").text(store.path("flags"))
    ready = ready_slices(spark, store.path("flags"), "*.txt", from_directory=True)
    return raw.join(ready, "_slice_date", "left_semi").select("event_id", "ts", "event_type", "_slice_date")


@query("""
    select c_custkey as id, c_name as name, c_nationkey as nation, c_acctbal as balance from customer
    union all select s_suppkey, s_name, s_nationkey, s_acctbal from supplier
""")
def json_parquet_landing(spark, sf_dir):
    store = new_store(spark, "formats")
    ddl = "id long, name string, nation int, balance double"
    frames = []
    for fmt, name, prefix, key in (("json", "customer", "c", "custkey"), ("parquet", "supplier", "s", "suppkey")):
        source = table(spark, sf_dir, name).select(
            F.col(f"{prefix}_{key}").alias("id"), F.col(f"{prefix}_name").alias("name"),
            F.col(f"{prefix}_nationkey").alias("nation"), F.col(f"{prefix}_acctbal").alias("balance"),
        )
        source.write.format(fmt).save(store.path(name))
        frames.append(read_landing(spark, store.path(name), ddl, fmt).select("id", "name", "nation", "balance"))
    return frames[0].unionByName(frames[1])


@query(f"select {_STAGED_SQL} from events where event_type <> 'error'")
def base_load(spark, sf_dir):
    """Landing files to raw to base."""
    store = new_store(spark, "base")
    path = landing_glob(land_events(spark, sf_dir, store), "events")
    load_raw(store, "raw", path, EVENT_DDL, 1, options=EVENTS_CSV, slice_from="path")
    load_base(store, "raw", "base")
    return store.read("base").select(*_STAGED)


@query(f"select {_STAGED_SQL} from events")
def stream_load(spark, sf_dir):
    """Landing files to raw as a stream; a second run finds nothing new."""
    store = new_store(spark, "stream")
    path = landing_glob(land_events(spark, sf_dir, store), "events")
    for _ in range(2):
        load_raw(
            store, "raw", path, EVENT_DDL, 1, mode="stream", options=EVENTS_CSV,
            checkpoint=store.path("checkpoint"), slice_from="path", drop_loaded=False,
        )
    return store.read("raw").select(*_STAGED)


@query("""
    select o_orderkey, o_orderstatus, case when o_orderstatus <> 'F' then o_orderpriority end as o_orderpriority
    from orders
""")
def schema_evolution_append(spark, sf_dir):
    store = new_store(spark, "evolve")
    orders = table(spark, sf_dir, "orders")
    store.append("orders", orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_orderstatus"))
    store.append("orders", orders.where("o_orderstatus <> 'F'").select("o_orderkey", "o_orderstatus", "o_orderpriority"))
    return store.read("orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query("""
    select t as run_order, o_orderkey, cast(case when o_orderstatus = 'F' then floor(o_totalprice)
        else cast(o_totalprice as decimal(14, 2)) end as double) as price,
      case when o_orderstatus = 'F' then cast(cast(o_totalprice as float) as double) else o_totalprice end as amount,
      'bigint, decimal(14,2), double' as types
    from orders, (values ('narrow first'), ('wide first')) v(t)
""")
def widened_append(spark, sf_dir):
    """Runs with narrow and wide types of the same columns, in both orders of writing and of run names."""
    store = new_store(spark, "widened")
    orders = table(spark, sf_dir, "orders")
    narrow = orders.where("o_orderstatus = 'F'").selectExpr(
        "cast(o_orderkey as int) as o_orderkey", "cast(floor(o_totalprice) as int) as price",
        "cast(o_totalprice as float) as amount",
    )
    wide = orders.where("o_orderstatus <> 'F'").selectExpr(
        "cast(o_orderkey as long) as o_orderkey", "cast(o_totalprice as decimal(14, 2)) as price",
        "cast(o_totalprice as double) as amount",
    )
    for name, steps in (("narrow first", (narrow, wide)), ("wide first", (wide, narrow))):
        for run, rows in zip(("b", "a"), steps):
            store.append(name.replace(" ", "_"), rows, run)
    return reduce(DataFrame.unionByName, (
        store.read(name.replace(" ", "_")).select(
            F.lit(name).alias("run_order"), "o_orderkey", F.col("price").cast("double").alias("price"), "amount",
            F.lit(", ".join(f.dataType.simpleString() for f in store.schema(name.replace(" ", "_")))).alias("types"),
        )
        for name in ("narrow first", "wide first")
    ))


@query("""
    select o_orderkey, o_orderstatus, case when o_orderstatus <> 'F' then o_orderpriority end as o_orderpriority
    from orders
""")
def evolving_load(spark, sf_dir):
    """Files of two layouts through raw to base, in two steps; the second layout has a column more."""
    store = new_store(spark, "evolving")
    orders = table(spark, sf_dir, "orders")
    for part, ddl in (("= 'F'", ""), ("<> 'F'", ", o_orderpriority string")):
        columns = ["o_orderkey", "o_orderstatus", *(["o_orderpriority"] if ddl else [])]
        orders.where(f"o_orderstatus {part}").select(*columns).write.json(store.path(f"landing/layout{len(ddl)}"))
        schema = "o_orderkey long, o_orderstatus string" + ddl
        load_raw(store, "raw", store.path(f"landing/layout{len(ddl)}"), schema, 1, fmt="json", slice_from=None)
        load_base(store, "raw", "base")
    return store.read("base").select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query(_ORDERS_SQL)
def orders_in_two_steps(spark, sf_dir):
    """Folders ``month=...`` under one directory, some loaded first and then all: the folder stays a column."""
    store = new_store(spark, "steps")
    orders = table(spark, sf_dir, "orders").withColumn("month", F.month("o_orderdate"))
    how = {"fmt": "parquet", "slice_from": None, "validity": False}
    schema = orders.select("*", F.col("o_orderdate").alias("_d")).drop("_d", "month").schema
    for some in ("month <= 6", "month > 6"):
        orders.where(some).write.mode("append").partitionBy("month").parquet(store.path("landing"))
        load_raw(store, "raw", store.path("landing"), schema, 1, **how)
    return store.read("raw").where(F.col("month") == F.month("o_orderdate")).select(*_ORDERS)


def _two_states(spark, sf_dir):
    """A stored table that was replaced: finished orders have gone, open ones have come, urgent ones cost more."""
    store = new_store(spark, "feed")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    dearer = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    store.replace("orders", orders.where("o_orderstatus <> 'O'"))
    store.replace("orders", orders.where("o_orderstatus <> 'F'").withColumn("o_totalprice", dearer))
    return store


@query("""
    select o_orderkey, o_totalprice + case when kind = 'update_postimage' or (kind = 'insert' and o_orderpriority = '1-URGENT')
               then 1 else 0 end as o_totalprice, kind as _change_type
    from (select *, unnest(case when o_orderstatus = 'O' then ['insert'] when o_orderstatus = 'F' then ['delete']
               when o_orderpriority = '1-URGENT' then ['update_preimage', 'update_postimage'] else [] end) as kind from orders)
""")
def change_feed_orders(spark, sf_dir):
    """What a replacement of a table changed, row by row."""
    return table_changes(_two_states(spark, sf_dir), "orders", ["o_orderkey"]).select("o_orderkey", "o_totalprice", "_change_type")


@query("select o_orderkey, o_orderstatus from orders where o_orderstatus = 'O'")
def inserted_rows_orders(spark, sf_dir):
    """The inserts of a computed change feed that also has updates and deletes."""
    feed = table_changes(_two_states(spark, sf_dir), "orders", ["o_orderkey"])
    return inserted_rows(feed).select("o_orderkey", "o_orderstatus")


@query(f"""
    with d as ({_DAYS_SQL})
    select d._slice_date, count(*) + 2 as file_rows, count(*) + 2 as block_rows,
           count(*) filter (where event_type <> 'error') as valid_rows, any_value(stated) as expected_rows,
           count(*) filter (where event_type = 'view') as views
    from d join events on strftime(ts, '%Y%m%d') = d.day group by d._slice_date
""")
def control_files_landed(spark, sf_dir):
    """Files in windows-1252 with a stored schema: raw, control records and audit by their real lineage."""
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    store = new_store(spark, "landed")
    lines = control_lines(spark, sf_dir).withColumn("line", F.expr("regexp_replace(line, ',view,', ',vue réelle,')"))
    # One file a day; each line is written as it is.
    lines.repartition("day").write.partitionBy("day").options(
        sep="\u0001", quote="\u0000", escape="\u0000", encoding="windows-1252"
    ).csv(store.path("landing"))
    with tempfile.TemporaryDirectory() as folder:  # read again by this process only
        save_schema(StructType.fromDDL(CONTROL_DDL), f"{folder}/events.json")
        schema = load_schema(f"{folder}/events.json")
    path = store.path("landing") + "/day=*/*.csv"
    run = load_raw(store, "raw", path, schema, 1, options=CONTROL_CSV, slice_from="path")
    load_header_footer(store, "raw", "header_footer", 1, raw_run=run)
    audited, blocks = (
        load_audit(store, "raw", f"audit_{grain}", 1, SOURCE, TARGET, grain=grain, raw_run=run)
        .where("file_size > 0 and file_name like 'part-%.csv'")
        .groupBy("_slice_date").agg(F.sum("total_count").alias(f"{grain}_rows"), F.sum("valid_count").alias("valid_rows"))
        for grain in ("file", "block")
    )
    # Files of several days may share a name here, so the control records go by slice.
    stated = store.read("header_footer").select("_slice_date", F.col("header.row_count").alias("expected_rows"))
    views = store.read("raw").where("event_type = 'vue réelle'").groupBy("_slice_date").agg(F.count("*").alias("views"))
    joined = audited.join(blocks.drop("valid_rows"), "_slice_date").join(stated, "_slice_date", "left")
    return joined.join(views, "_slice_date", "left").select(
        "_slice_date", "file_rows", "block_rows", "valid_rows", "expected_rows",
        F.coalesce("views", F.lit(0)).alias("views"),
    )


@query(_ORDERS_SQL)
def clustered_layout(spark, sf_dir):
    store = new_store(spark, "cluster")
    store.append("orders", table(spark, sf_dir, "orders"), cluster_by=["o_orderdate"])
    return store.read("orders").select(*_ORDERS)


@query("""
    select l_orderkey, l_linenumber, l_partkey, l_shipdate from lineitem
    where l_partkey between 100 and 110 or l_shipdate >= (select max(l_shipdate) from lineitem) - interval 30 day
""")
def interleaved_layout(spark, sf_dir):
    """Two columns clustered together; the filter on either reads part of the row groups."""
    store = new_store(spark, "interleaved")
    store.append("lineitem", table(spark, sf_dir, "lineitem"), cluster_by=["l_shipdate", "l_partkey"])
    rows = store.read("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    recent = rows.agg(F.max("l_shipdate") - F.expr("interval 30 days")).first()[0]
    return rows.where(F.col("l_partkey").between(100, 110) | (F.col("l_shipdate") >= F.lit(recent)))


@query("select o_orderkey, o_totalprice, cast(o_orderdate as date) as order_day from orders")
def partitioned_layout(spark, sf_dir):
    """Partitions by month; within the year asked for, only its directories are read."""
    store = new_store(spark, "partition")
    store.append(
        "orders", table(spark, sf_dir, "orders"),
        partition_by={"order_month": F.date_format("o_orderdate", "yyyy-MM")},
    )
    return store.read("orders").select("o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("order_day"))


@query(_ORDERS_SQL)
def infer_schema_orders(spark, sf_dir):
    """Infer a schema from files, override two types by hints, and read with the result."""
    store = new_store(spark, "infer")
    path = landing_glob(land_orders(spark, sf_dir, store), "orders", "*", "%Y%m")
    schema = merge_hints(
        infer_schema(spark, path, options=DELIMITED_CSV), "o_orderkey long, o_custkey long"
    )
    return read_landing(spark, path, schema, options=DELIMITED_CSV).select(*_ORDERS)


# ---------------------------------------------------------------------------------------------
# Change data and history


@query("""
    select user_id, ts, event_id, event_type, value from (
        select *, row_number() over (partition by user_id order by ts desc, event_id desc) as n from events)
    where n = 1 and event_type <> 'error'
""")
def cdc_current(spark, sf_dir):
    """The last event per user is the current state; an error event deletes the user."""
    changes = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return apply_cdc(changes, ["user_id"], ["ts", "event_id"], "event_type", ("error",))


def _status_sql(key: str) -> str:
    return f"""
    with o as (select *, lag(o_orderstatus) over (partition by {key} order by o_orderdate, o_orderkey) as before
               from orders),
    k as (select * from o where before is null or before <> o_orderstatus)
    select {key}, o_orderstatus, o_orderdate as start_date, o_orderkey as start_order,
           lead(o_orderdate) over (partition by {key} order by o_orderdate, o_orderkey) as end_date
    from k
"""


def _status_history(orders: DataFrame, key: str, **how) -> DataFrame:
    changes = orders.select(key, "o_orderdate", "o_orderkey", "o_orderstatus")
    return _status_columns(
        scd2(changes, [key], ["o_orderdate", "o_orderkey"], except_cols=("o_orderdate", "o_orderkey"), **how), key
    )


def _status_columns(versions: DataFrame, key: str) -> DataFrame:
    return versions.select(
        key, "o_orderstatus",
        F.col(f"{START}.o_orderdate").alias("start_date"),
        F.col(f"{START}.o_orderkey").alias("start_order"),
        F.col(f"{END}.o_orderdate").alias("end_date"),
    )


@query(_status_sql("o_custkey"))
def history_in_steps(spark, sf_dir):
    """A history brought up to date in three steps that are out of order: the newest years, the oldest, those between."""
    store = new_store(spark, "spliced")
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus")
    how = (["o_custkey"], ["o_orderdate", "o_orderkey"])
    for years in ((1996, 9999), (0, 1993), (1994, 1995)):
        store.append("raw", orders.where(F.year("o_orderdate").between(*years)))
        splice_history(store, "raw", "base", *how, except_cols=("o_orderdate", "o_orderkey"), buckets=8)
    return _status_columns(read_spliced(store, "base", *how), "o_custkey")


@query("""
    with late as (select *, date_trunc('day', ts) as _slice_date from events)
    select user_id, event_id, event_type, value from (
        select *, row_number() over (partition by user_id order by _slice_date desc, value desc, event_id desc) as n
        from late where event_type <> 'error')
    where n = 1
""")
def current_load(spark, sf_dir):
    """Raw on disk to a stored current state, in the order of slice and then of a source column."""
    store = new_store(spark, "current")
    store.append("raw", raw_events(spark, sf_dir))
    load_current(store, "raw", "base", ["user_id"], ["_slice_date", "value", "event_id"])
    return store.read("base").select("user_id", "event_id", "event_type", "value")


@query(_status_sql("o_custkey"))
def scd2_customer_status(spark, sf_dir):
    return _status_history(table(spark, sf_dir, "orders"), "o_custkey")


@query(_status_sql("o_custkey"))
def scd2_shuffled(spark, sf_dir):
    """Every row twice and in another order: the history must be the same."""
    orders = table(spark, sf_dir, "orders")
    return _status_history(orders.unionByName(orders).repartition("o_totalprice"), "o_custkey")


@query(_status_sql("o_orderpriority"))
def scd2_hot_keys(spark, sf_dir):
    """Five keys hold all rows; each is cut into many pieces along its order."""
    return _status_history(table(spark, sf_dir, "orders"), "o_orderpriority", split_rows=2_000)


@query("""
    with e as (select user_id, event_type, ts, event_id,
                      lag(event_type) over (partition by user_id order by ts, event_id) as before from events),
    k as (select * from e where before is null or before <> event_type),
    v as (select *, lead(ts) over (partition by user_id order by ts, event_id) as end_at from k)
    select user_id, event_type, ts as start_at, end_at from v where event_type <> 'error'
""")
def scd2_deletes(spark, sf_dir):
    """An error event closes the open version of its user and starts none."""
    changes = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type")
    versions = scd2(
        changes, ["user_id"], "ts", except_cols=("ts", "event_id"), tie_cols=("event_id",),
        delete_when="event_type = 'error'",
    )
    return versions.select(
        "user_id", "event_type", F.col(START).alias("start_at"), F.col(END).alias("end_at")
    )


@query(_status_sql("o_custkey"))
def scd2_stream(spark, sf_dir):
    """Orders arrive in several files, by price and so out of order, over several micro-batches."""
    store = new_store(spark, "history")
    changes = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus", "o_totalprice")
    changes.repartitionByRange(4, "o_totalprice").drop("o_totalprice").write.parquet(store.path("changes"))
    stream = (
        spark.readStream.schema(spark.read.parquet(store.path("changes")).schema)
        .option("maxFilesPerTrigger", 2).parquet(store.path("changes"))
    )
    stream_scd2(
        store, stream, "log", "history", store.path("checkpoint"), ["o_custkey"],
        ["o_orderdate", "o_orderkey"], except_cols=("o_orderdate", "o_orderkey"), buckets=8,
    )
    return _status_columns(read_history(store, "history"), "o_custkey")


@query("""
    with o as (select *, lag(o_orderstatus) over (partition by o_custkey order by o_orderdate, o_orderkey) as before
               from orders),
    k as (select * from o where before is null or before <> o_orderstatus),
    v as (select *, lead(o_orderdate) over (partition by o_custkey order by o_orderdate, o_orderkey) as end_date from k)
    select o_custkey, o_orderstatus, o_orderdate as start_date, end_date from v
    where o_orderdate <= timestamp '1998-06-30' and (end_date is null or end_date > timestamp '1998-06-30')
""")
def scd2_as_of(spark, sf_dir):
    changes = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus")
    versions = scd2(
        changes, ["o_custkey"], "o_orderdate", except_cols=("o_orderdate", "o_orderkey"), tie_cols=("o_orderkey",)
    )
    return as_of(versions, "1998-06-30").select(
        "o_custkey", "o_orderstatus", F.col(START).alias("start_date"), F.col(END).alias("end_date")
    )


@query("""
    with o as (select *, lag(o_orderstatus) over (partition by o_custkey, o_orderpriority order by o_orderdate, o_orderkey) as before
               from orders),
    k as (select * from o where before is null or before <> o_orderstatus)
    select o_custkey, o_orderpriority, o_orderstatus, o_orderdate as start_date, lead(o_orderdate) over (
        partition by o_custkey, o_orderpriority order by o_orderdate, o_orderkey) as end_date
    from k
""")
def base_history(spark, sf_dir):
    """Raw on disk to a stored history with a composite key."""
    store = new_store(spark, "base-history")
    store.append("raw", table(spark, sf_dir, "orders"))
    load_history(
        store, "raw", "base", ["o_custkey", "o_orderpriority"], "o_orderdate",
        except_cols=("o_orderdate", "o_orderkey", "o_totalprice"), tie_cols=("o_orderkey",),
    )
    return store.read("base").select(
        "o_custkey", "o_orderpriority", "o_orderstatus",
        F.col(START).alias("start_date"), F.col(END).alias("end_date"),
    )


@query("""
    select o_orderkey, o_orderdate, o_totalprice from orders
    where o_orderstatus = 'F' and o_orderpriority = '2-HIGH'
""")
def key_history(spark, sf_dir):
    """All rows of one composite key, in order."""
    key = {"o_orderstatus": "F", "o_orderpriority": "2-HIGH"}
    rows = history(table(spark, sf_dir, "orders"), key, ["o_orderdate", "o_orderkey"])
    return rows.select("o_orderkey", "o_orderdate", "o_totalprice")


@query("select event_id, user_id, event_type from events where event_type = 'error'")
def unsequenced_changes(spark, sf_dir):
    """Changes whose sequence value could not be read are set aside."""
    raw = raw_events(spark, sf_dir)
    return unsequenced(raw, "value").select("event_id", "user_id", "event_type")


# ---------------------------------------------------------------------------------------------
# Quality


@query("""
    select l_orderkey, l_linenumber, count(*) as row_count from lineitem
    group by all having count(*) > 1
""")
def duplicate_keys_lineitem(spark, sf_dir):
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
    select 'orders' as table_name, count(*) as total_rows, count(distinct o_orderkey) as distinct_keys,
           (select count(*) from (select 1 from orders group by o_orderkey having count(*) > 1)) as repeated_keys,
           count(*) = count(distinct o_orderkey) as is_unique from orders
    union all
    select 'lineitem', sum(n), count(*), count(*) filter (where n > 1), max(n) = 1
    from (select count(*) as n from lineitem group by l_orderkey, l_linenumber)
""")
def check_unique_keys(spark, sf_dir):
    reports = [
        check_unique(table(spark, sf_dir, name), keys).select(F.lit(name).alias("table_name"), "*")
        for name, keys in (("orders", ["o_orderkey"]), ("lineitem", ["l_orderkey", "l_linenumber"]))
    ]
    return reports[0].unionByName(reports[1])


_RULES = {
    "quantity_positive": "l_quantity > 0",
    "discount_small": "l_discount <= 0.05",
    "not_returned": "l_returnflag <> 'R'",
}


@query(" union all ".join(
    f"select '{name}' as constraint_name, '{rule.replace(chr(39), chr(39) * 2)}' as predicate, "
    f"count(*) as checked_rows, count(*) filter (where ({rule}) is not true) as failed_rows from lineitem"
    for name, rule in _RULES.items()
))
def constraints_report(spark, sf_dir):
    return check_constraints(table(spark, sf_dir, "lineitem"), _RULES)


@query("""
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_discount, l_returnflag,
           concat_ws(',', case when not (l_quantity > 0) then 'quantity_positive' end,
                          case when not (l_discount <= 0.05) then 'discount_small' end,
                          case when l_returnflag = 'R' then 'not_returned' end) as failed
    from lineitem
    where not (l_quantity > 0) or not (l_discount <= 0.05) or l_returnflag = 'R'
""")
def constraints_quarantine(spark, sf_dir):
    _, failing = split_constraints(table(spark, sf_dir, "lineitem"), _RULES)
    return failing.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_returnflag",
        F.array_join("_failed", ",").alias("failed"),
    )


@query("""
    select 'table' as place, l_orderkey, l_linenumber, '' as failed from lineitem where l_discount <= 0.05
    union all
    select 'aside', l_orderkey, l_linenumber, case when l_tax >= 0.08 then 'discount,tax' else 'discount' end
    from lineitem where l_discount > 0.05
""")
def constraints_on_write(spark, sf_dir):
    """Rules kept with a table: the run that breaks them is refused and its failing rows are shown."""
    store = new_store(spark, "enforced")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_tax")
    store.constrain("lines", {"discount": "l_discount <= 0.05", "tax": "l_discount <= 0.05 or l_tax < 0.08"})
    store.append("lines", lines.where("l_discount <= 0.05"), "good")
    try:
        store.append("lines", lines.where("l_discount > 0.05"), "bad")
    except BrokenRules as refused:
        aside = store.left_aside("lines", refused.runs)
    return (
        store.read("lines").select(F.lit("table").alias("place"), "l_orderkey", "l_linenumber", F.lit("").alias("failed"))
        .unionByName(aside.select(
            F.lit("aside").alias("place"), "l_orderkey", "l_linenumber", F.concat_ws(",", "_failed").alias("failed")
        ))
    )


@query("""
    select 'events-' || strftime(ts, '%Y%m%d') || '.csv' as file_name, event_type <> 'error' as _is_valid,
           count(*) as row_count
    from events group by all having count(*) > 1
""")
def named_views(spark, sf_dir):
    """Datasets read by name in SQL, grouped by all selected columns, one of them in a struct."""
    raw_events(spark, sf_dir).createOrReplaceTempView("lakeload_raw_events")
    return spark.sql("""
        select _metadata.file_name, _is_valid, count(1) as row_count
        from lakeload_raw_events group by all having count(1) > 1
    """)


@query("select distinct source, lang from documents")
def distinct_sources(spark, sf_dir):
    return distinct_rows(table(spark, sf_dir, "documents"), ["source", "lang"])


@query("""
    with c as (
        select 'C' || c_custkey as id, c_name as name, c_nationkey as nation, c_acctbal as balance, c_mktsegment as segment
        from customer
        union all select 'S' || s_suppkey, s_name, s_nationkey, s_acctbal, null from supplier),
    p as (select 'C' || o_custkey as id, max(o_orderdate) as last_order, count(*) as orders from orders group by 1)
    select c.id, c.name, c.balance, c.segment, n_name as nation_name, p.last_order, coalesce(p.orders, 0) as orders
    from c left join p on c.id = p.id left join nation on n_nationkey = c.nation
""")
def customers_joined(spark, sf_dir):
    customer, supplier = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    first = customer.select(
        F.concat(F.lit("C"), "c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    second = supplier.select(
        F.concat(F.lit("S"), "s_suppkey").alias("id"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance"),
    )
    preferences = (
        table(spark, sf_dir, "orders")
        .groupBy(F.concat(F.lit("C"), "o_custkey").alias("id"))
        .agg(F.max("o_orderdate").alias("last_order"), F.count(F.lit(1)).alias("orders"))
    )
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("nation"), F.col("n_name").alias("nation_name")
    )
    return build_customers([first, second], preferences).join(nation, "nation", "left").select(
        "id", "name", "balance", "segment", "nation_name", "last_order",
        F.coalesce("orders", F.lit(0)).alias("orders"),
    )
