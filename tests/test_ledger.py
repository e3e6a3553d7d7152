import pytest
from pyspark.sql import functions as F

from conftest import rows
from control_files import DETAILS_DDL, write_file
from lakeload.operators import ledger
from lakeload.plans import jobs
from lakeload.plans.jobs import copy_into, load_audit, load_raw
from lakeload.sources import CONTROL_CSV

TABLE = "customer_details_1"


@pytest.fixture(params=["listed", "one by one", "salted"])
def strategy(request, monkeypatch):
    """Every way of leaving out loaded files must give the same rows."""
    if request.param != "listed":
        monkeypatch.setattr(ledger, "FILES_PER_RUN", 1)
    if request.param == "salted":
        monkeypatch.setattr(ledger, "BROADCAST_FILES", 0)
    return request.param


def load(store, tmp_path, process_id, **how):
    return load_raw(
        store, "raw", str(tmp_path / "in" / TABLE / "*"), DETAILS_DDL, process_id,
        options=CONTROL_CSV, **how,
    )


def counts(store):
    return rows(store.read("raw").groupBy("_process_id", "_metadata.file_name").count())


def test_rerun_adds_only_new_files(store, tmp_path, strategy):
    write_file(tmp_path / "in", TABLE, "20230101")
    load(store, tmp_path, 1)
    load(store, tmp_path, 2)
    assert counts(store) == [(1, f"{TABLE}-20230101.csv", 12)]
    write_file(tmp_path / "in", TABLE, "20230102")
    load(store, tmp_path, 3)
    load(store, tmp_path, 4, mode="stream", checkpoint=store.path("cp"))
    assert counts(store) == [(1, f"{TABLE}-20230101.csv", 12), (3, f"{TABLE}-20230102.csv", 14)]


def test_kept_ledger_follows_the_lineage(spark, store, tmp_path, monkeypatch):
    """Runs the ledger does not know are caught up, each once."""
    for day in ("20230101", "20230102", "20230103"):
        write_file(tmp_path / "in", TABLE, day)
        load(store, tmp_path, 1)
    assert store.read("raw_files").groupBy("run").count().count() == 2
    whole = rows(ledger.file_ledger(store.read("raw")))
    assert rows(jobs.loaded_files(store, "raw")) == whole
    assert len(whole) == 3 and store.read("raw_files").count() == 3
    assert rows(jobs.loaded_files(store, "raw")) == whole and store.read("raw_files").count() == 3


def test_only_new_runs_are_scanned_for_their_files(spark, store, tmp_path):
    write_file(tmp_path / "in", TABLE, "20230101")
    load(store, tmp_path, 1)
    assert rows(store.read_run("raw", "none")) == []
    table = store.read_with_runs("raw").where(~F.col("_load").isin(["run-a", "run-b"]))
    assert "PartitionFilters: [NOT _load" in table._jdf.queryExecution().executedPlan().toString()


def test_run_of_a_load_limits_its_audit(store, tmp_path):
    write_file(tmp_path / "in", TABLE, "20230101")
    first = load(store, tmp_path, 1)
    assert load(store, tmp_path, 1) is None
    write_file(tmp_path / "in", TABLE, "20230102")
    second = load(store, tmp_path, 1)
    for run, total in ((first, 12), (second, 14)):
        jobs.load_header_footer(store, "raw", f"hf-{run}", 1, raw_run=run)
        audited = load_audit(
            store, "raw", "audit", 1, ("landing", TABLE), ("raw", "raw"),
            header_footer_table=f"hf-{run}", raw_run=run,
        )
        assert rows(audited, "total_count") == [(total,)]


def test_replayed_stream_load_keeps_its_rows(store, tmp_path, strategy):
    """A micro-batch that runs again finds its own files in the ledger and must not drop them."""
    write_file(tmp_path / "in", TABLE, "20230101")
    load(store, tmp_path, 1)
    write_file(tmp_path / "in", TABLE, "20230102")
    for _ in range(2):
        load(store, tmp_path, 2, mode="stream", checkpoint=store.path("cp"))
        assert counts(store) == [(1, f"{TABLE}-20230101.csv", 12), (2, f"{TABLE}-20230102.csv", 14)]
        assert rows(jobs.loaded_files(store, "raw")) == rows(ledger.file_ledger(store.read("raw")))
        for commit in (tmp_path / "store" / "cp" / "commits").glob("*0*"):
            commit.unlink()


def test_without_ledger_files_load_again(store, tmp_path):
    write_file(tmp_path / "in", TABLE, "20230101")
    load(store, tmp_path, 1)
    load(store, tmp_path, 1, drop_loaded=False)
    assert counts(store) == [(1, f"{TABLE}-20230101.csv", 24)]


def test_audit_as_ledger_and_loose_key(store, tmp_path, strategy):
    write_file(tmp_path / "in", TABLE, "20230101")
    load(store, tmp_path, 1)
    load_audit(store, "raw", "audit", 1, ("landing", TABLE), ("raw", "raw"))
    keys = ["file_name", "file_modification_time"]
    loaded = ledger.audit_ledger(store.read("audit"), TABLE, keys)
    other = ledger.audit_ledger(store.read("audit"), "another_table", keys)
    assert loaded.count() == 1 and other.count() == 0
    load(store, tmp_path, 2, ledger=loaded, ledger_keys=keys)
    assert len(counts(store)) == 1
    load(store, tmp_path, 3, ledger=other, ledger_keys=keys)
    assert len(counts(store)) == 2


def test_copy_into(store, tmp_path, strategy):
    path = str(tmp_path / "in" / TABLE / "*")
    for day, total in (("20230101", 12), ("20230102", 26)):
        write_file(tmp_path / "in", TABLE, day)
        copy_into(store, "copied", path, DETAILS_DDL, options=CONTROL_CSV)
        copy_into(store, "copied", path, DETAILS_DDL, options=CONTROL_CSV)
        assert store.read("copied").count() == total
    assert "_metadata" in store.read("copied").columns
    assert store.read("copied").select("_metadata.file_name").distinct().count() == 2


@pytest.mark.parametrize("folder", ["a b c", "p%d", "[x]", "day=2024-01-01", "{y},z"])
def test_names_are_read_as_written(spark, store, tmp_path, folder):
    """The first load and a later one read alike: same columns, each file once."""
    for step, n in (("1", 3), ("2", 5)):
        place = tmp_path / "in" / folder
        place.mkdir(parents=True, exist_ok=True)
        (place / f"{folder.replace('/', '')} {step}-20240101.csv").write_text("".join(f"{i}\n" for i in range(n)))
        load_raw(store, "raw", str(tmp_path / "in"), "id long", int(step), slice_from=None)
        load_raw(store, "raw", str(tmp_path / "in"), "id long", int(step), slice_from=None)
    raw = store.read("raw")
    assert rows(raw.groupBy("_process_id").count()) == [(1, 3), (2, 5)]
    assert ("day" in raw.columns) == folder.startswith("day=")
    assert not folder.startswith("day=") or raw.where("day is null").count() == 0


def test_half_a_ledger_is_made_good(spark, store, tmp_path):
    for day in ("20230101", "20230102", "20230103"):
        write_file(tmp_path / "in", TABLE, day)
    load(store, tmp_path, 1)
    total = store.read("raw").count()
    assert load(store, tmp_path, 2) is None
    parts = sorted((tmp_path / "store" / "raw_files").glob("_load=*/part-*"))
    parts[0].unlink()
    assert load(store, tmp_path, 3) is None
    assert store.read("raw").count() == total and jobs.loaded_files(store, "raw").distinct().count() == 3


def test_replay_is_no_second_insert(spark, store, tmp_path):
    """A raw micro-batch that runs again leaves its files, so a stream that has read them sees nothing new."""
    write_file(tmp_path / "in", TABLE, "20230101")
    for _ in range(2):
        load(store, tmp_path, 1, mode="stream", checkpoint=store.path("cp"))
        jobs.load_header_footer(store, "raw", "hf", 1, mode="stream", checkpoint=store.path("cp-hf"))
        assert store.read("hf").count() == 1
        for commit in (tmp_path / "store" / "cp" / "commits").glob("*0*"):
            commit.unlink()


def test_listing_tasks_do_not_follow_bytes(spark, tmp_path):
    from lakeload.sources.files import list_files

    for i in range(40):
        (tmp_path / f"f{i}.csv").write_bytes(b"x" * 1_000_000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    listed = list_files(spark, str(tmp_path))
    assert listed.count() == 40 and spark.conf.get("spark.sql.files.maxPartitionBytes") == before
    assert len(listed.inputFiles()) <= spark.sparkContext.defaultParallelism + 1
