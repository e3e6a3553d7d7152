"""Control files through raw, header/footer, audit and reconciliation."""

import datetime as dt

import pytest

from conftest import rows
from control_files import DAYS, DETAILS_DDL, PREFERENCES_DDL, SHAPE, write_all, write_file
from lakeload.operators.audit import (
    ThresholdBreach,
    audit,
    evaluate_thresholds,
    merge_thresholds,
    reconcile,
    thresholds_struct,
)
from lakeload.operators.control import header_footer
from lakeload.plans.jobs import (
    create_control_tables,
    load_audit,
    load_header_footer,
    load_raw,
)
from lakeload.sources import (
    AUDIT_SCHEMA,
    CONTROL_AUDIT_SCHEMA,
    CONTROL_CSV,
    HEADER_FOOTER_SCHEMA,
    landing_glob,
)

TABLES = ["customer_details_1", "customer_details_2", "customer_preferences"]


def ddl(table):
    return PREFERENCES_DDL if table == "customer_preferences" else DETAILS_DDL


def load(store, root, table, mode="batch", process_id=1, timeslice="*", template=None, **how):
    path = landing_glob(template or write_all(root, table), table, timeslice)
    load_raw(store, table, path, ddl(table), process_id, mode, options=CONTROL_CSV, **how)


@pytest.mark.parametrize("mode", ["batch", "stream"])
@pytest.mark.parametrize("table", TABLES)
def test_golden_audit(store, tmp_path, table, mode):
    how = {"checkpoint": store.path("cp")} if mode == "stream" else {}
    load(store, tmp_path, table, mode, **how)
    how = {"checkpoint": store.path("cp_hf")} if mode == "stream" else {}
    load_header_footer(store, table, "header_footer", 1, mode, **how)
    thresholds = {"invalid_rows": 2, "min_rows": 1}
    audited = load_audit(
        store, table, "audit", 1, ("landing", table), ("raw", table), exception=thresholds,
        header_footer_table="header_footer",
    )
    result = evaluate_thresholds(reconcile(audited))
    wanted = []
    for day in DAYS:
        body, stated = SHAPE[table, day]
        wanted.append((
            f"{table}-{day}.csv", body + 2, body, 2, round(2 / (body + 2), 6), stated,
            body == stated, "ok", dt.datetime.strptime(day, "%Y%m%d"),
        ))
    got = result.selectExpr(
        "file_name", "total_count", "valid_count", "invalid_count", "round(invalid_ratio, 6)",
        "expected_row_count", "is_reconciled", "status", "_slice_date",
    )
    assert rows(got) == wanted
    assert audited.schema.simpleString() == CONTROL_AUDIT_SCHEMA.simpleString()


def test_header_footer_rows(store, tmp_path):
    load(store, tmp_path, "customer_details_1")
    load_header_footer(store, "customer_details_1", "hf", 1)
    hf = store.read("hf")
    assert hf.schema.simpleString() == HEADER_FOOTER_SCHEMA.simpleString()
    first = hf.where("file_name like '%20230101%'").first()
    assert first.header.asDict() == {
        "flag": "H", "row_count": 10, "period": 20230101132154, "batch": "batch1"
    }
    assert first.footer.asDict() == {
        "flag": "F", "name": "customer_details_1", "period": 20230101133443
    }
    assert first.raw_header == '"H",10,20230101132154,batch1'
    assert first.file_path.endswith("/customer_details_1/20230101/customer_details_1-20230101.csv")


def test_missing_control_records(store, tmp_path):
    table = "customer_details_2"
    write_file(tmp_path, table, "20230101", footer=False)
    write_file(tmp_path, table, "20230102", header=False)
    write_file(tmp_path, table, "20230103")
    load_raw(store, table, str(tmp_path / table / "*"), ddl(table), 1, options=CONTROL_CSV)
    raw = store.read(table)
    assert rows(header_footer(raw, 1), "file_name") == [(f"{table}-20230103.csv",)]
    full = header_footer(raw, 1, "full").selectExpr(
        "file_name", "raw_header is null", "raw_footer is null", "_process_id"
    )
    assert rows(full) == [
        (f"{table}-20230101.csv", False, True, 1),
        (f"{table}-20230102.csv", True, False, 1),
        (f"{table}-20230103.csv", False, False, 1),
    ]


def test_other_processes_stay_out(store, tmp_path):
    template = write_all(tmp_path, "customer_details_1")
    for process_id, timeslice in ((1, "2023-01-01"), (2, "2023-01-*")):
        load(
            store, tmp_path, "customer_details_1", process_id=process_id, timeslice=timeslice,
            template=template,
        )
    raw = store.read("customer_details_1")
    assert raw.groupBy("_process_id").count().orderBy("_process_id").collect() == [(1, 12), (2, 28)]
    assert header_footer(raw, 2).count() == 2
    assert audit(raw, 1, ("l", "t"), ("r", "t")).count() == 1


def test_block_grain(spark, store, tmp_path):
    """A file read in several blocks is one audit row per file, or one per block when asked."""
    load(store, tmp_path, "customer_details_1", timeslice="2023-01-01")
    raw = store.read("customer_details_1")
    split = raw.selectExpr(
        "* except (_metadata)",
        "named_struct('file_path', _metadata.file_path, 'file_name', _metadata.file_name, "
        "'file_size', _metadata.file_size, 'file_block_start', if(id > 5, 500L, 0L), "
        "'file_block_length', 500L, 'file_modification_time', _metadata.file_modification_time) as _metadata",
    )
    whole = audit(split, 1, ("l", "t"), ("r", "t"))
    assert rows(whole, "total_count", "file_block_start") == [(12, 0)]
    assert whole.schema.simpleString() == AUDIT_SCHEMA.simpleString()
    blocks = audit(split, 1, ("l", "t"), ("r", "t"), grain="block")
    assert rows(blocks, "file_block_start", "total_count", "invalid_count") == [(0, 7, 2), (500, 5, 0)]


@pytest.mark.parametrize(
    "warning, exception, status",
    [
        ({}, {}, "ok"),
        ({"invalid_rows": 2}, {"invalid_rows": 2}, "ok"),
        ({"invalid_rows": 1}, {"invalid_rows": 2}, "warning"),
        ({"invalid_rows": 1}, {"invalid_ratio": 0.1}, "exception"),
        ({"invalid_ratio": 0.1}, {"invalid_ratio": 0.5}, "warning"),
        ({"max_rows": 12}, {"min_rows": 12}, "ok"),
        ({"max_rows": 11}, {}, "warning"),
        ({}, {"min_rows": 13}, "exception"),
    ],
)
def test_thresholds(store, tmp_path, warning, exception, status):
    load(store, tmp_path, "customer_details_1", timeslice="2023-01-01")
    audited = audit(store.read("customer_details_1"), 1, ("l", "t"), ("r", "t"), warning, exception)
    assert [r.status for r in evaluate_thresholds(audited).collect()] == [status]


def test_breach_raises_after_the_audit_is_stored(store, tmp_path):
    load(store, tmp_path, "customer_details_1")
    create_control_tables(store, ["audit"])
    names = (("landing", "customer_details_1"), ("raw", "customer_details_1"))
    load_audit(store, "customer_details_1", "audit", 1, *names, exception={"max_rows": 14}, enforce=True)
    with pytest.raises(ThresholdBreach, match="2 files"):
        load_audit(store, "customer_details_1", "audit", 1, *names, exception={"max_rows": 13}, enforce=True)
    assert store.read("audit").count() == 6


def test_create_control_tables(store):
    create_control_tables(store, ["raw_audit", "base_audit"], "hf")
    assert store.read("base_audit").schema.simpleString() == CONTROL_AUDIT_SCHEMA.simpleString()
    assert store.read("hf").count() == 0


def test_table_thresholds_win():
    assert merge_thresholds({"invalid_rows": 0, "min_rows": 1}, {"invalid_rows": 2}) == {
        "invalid_rows": 2, "min_rows": 1
    }
    assert merge_thresholds(None, None) == {}


def test_unknown_threshold(spark):
    with pytest.raises(ValueError, match="bad_rows"):
        thresholds_struct({"bad_rows": 1})


def test_full_match_of_a_file_without_a_date(store, tmp_path):
    """Both records of a file whose name has no date are one row of the full match."""
    (tmp_path / "plain.csv").write_bytes(b'"H",1,20230101000000,b\r\n"I",1\r\n"F",plain,20230101000000\r\n')
    schema = "flag string, a long, b long, c long, d long"
    load_raw(store, "raw", str(tmp_path / "plain.csv"), schema, 1, options=CONTROL_CSV)
    full = header_footer(store.read("raw"), 1, how="full")
    assert [(r.raw_header is None, r.raw_footer is None) for r in full.collect()] == [(False, False)]
    assert header_footer(store.read("raw"), 1).count() == 0


def test_audit_by_block_from_the_job(store, tmp_path):
    load(store, tmp_path, TABLES[0])
    audited = load_audit(store, TABLES[0], "audit", 1, ("landing", "x"), ("raw", "x"), grain="block")
    assert audited.where("file_block_length is null").count() == 0
    assert sum(r.total_count for r in audited.collect()) == store.read(TABLES[0]).count()
