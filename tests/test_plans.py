"""The physical plans are the ones meant: pruned scans, few shuffles, no cross joins."""

import re

import pytest
from lakeload.operators.audit import audit
from lakeload.operators.cdc import apply_cdc, scd2
from lakeload.operators.control import header_footer
from lakeload.operators.ledger import file_ledger, skip_loaded
from lakeload.operators.quality import check_constraints
from lakeload.operators.stage import retain
from lakeload.plans.queries import raw_control

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(re.findall(r"Exchange (?:hash|range|round)", plan(df)))


@pytest.fixture
def raw(spark, store):
    store.append("raw", raw_control(spark, SF))
    return store.read("raw")


def test_scd2_is_one_shuffle_and_one_sort(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    df = scd2(
        orders.select("o_custkey", "o_orderdate", "o_orderstatus"), ["o_custkey"], "o_orderdate",
        except_cols=("o_orderdate",),
    )
    assert shuffles(df) == 1
    assert plan(df).count("Sort [") == 1
    assert "ReadSchema: struct<o_custkey:bigint,o_orderstatus:string,o_orderdate:timestamp_ntz>" in plan(df)


def test_audit_reads_few_columns_and_shuffles_once(raw):
    df = audit(raw, 1, ("l", "t"), ("r", "t"))
    text = plan(df)
    assert shuffles(df) == 1
    assert "PushedFilters: [IsNotNull(_process_id), EqualTo(_process_id,1)]" in text
    assert "event_type" not in text and "_corrupt_record" not in text
    assert "partial_count" in text


def test_control_records_are_filtered_in_the_scan(raw):
    text = plan(header_footer(raw, 1))
    assert "EqualTo(flag,H)" in text and "EqualTo(flag,F)" in text
    assert "event_type" not in text


def test_ledger_is_broadcast_as_anti_join(raw):
    text = plan(skip_loaded(raw, file_ledger(raw)))
    assert "LeftAnti" in text and "BroadcastHashJoin" in text


def test_ledger_reads_lineage_only(raw):
    text = plan(file_ledger(raw))
    assert "ReadSchema: struct<_metadata:struct<file_path:string,file_name:string,file_size:bigint" in text


def test_current_state_combines_before_the_shuffle(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    df = apply_cdc(orders.select("o_custkey", "o_orderdate", "o_orderstatus"), ["o_custkey"], "o_orderdate")
    assert shuffles(df) == 1 and "partial_max" in plan(df)


def test_constraints_are_one_scan(spark):
    lineitem = spark.read.parquet(f"{SF}/lineitem.parquet")
    df = check_constraints(lineitem, {"a": "l_quantity > 0", "b": "l_tax < 1"})
    assert plan(df).count("FileScan") == 1
    assert "ReadSchema: struct<l_quantity:double,l_tax:double>" in plan(df)


def test_retention_bound_is_pushed(spark):
    df = retain(spark.read.parquet(f"{SF}/events.parquet"), 7, column="ts")
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in plan(df)


def test_no_cross_joins(spark, raw):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    changes = orders.select("o_orderpriority", "o_orderkey", "o_orderstatus")
    hot = scd2(changes, ["o_orderpriority"], "o_orderkey", split_rows=100)
    for df in (hot, header_footer(raw, 1, "full"), skip_loaded(raw, file_ledger(raw))):
        assert "CartesianProduct" not in plan(df) and "NestedLoop" not in plan(df)


def _raw_with_runs(store, spark, runs):
    for i in range(runs):
        rows = spark.range(i * 10, i * 10 + 10, numPartitions=2).selectExpr(
            "id", "id % 10 <> 3 and {} as _is_valid".format("false" if i == 4 else "true"),
            f"named_struct('file_path', '/f{i}', 'file_name', 'f{i}', 'file_size', 1L, "
            "'file_modification_time', timestamp '2024-01-01') as _metadata",
        )
        store.append("raw", rows, f"r{i:02d}")


def opened_files(df):
    """Files that the scans of a plan open, after partitions are pruned."""
    leaves = df._jdf.queryExecution().sparkPlan().collectLeaves()
    out = []
    for i in range(leaves.size()):
        if not leaves.apply(i).nodeName().startswith("Scan parquet"):
            continue
        for part in leaves.apply(i).inputRDDs().apply(0).partitions():
            out += [f.filePath().toString() for f in part.files()]
    return out


def test_base_and_ledger_open_only_new_runs(spark, store, monkeypatch):
    from lakeload.plans.jobs import load_base, loaded_files
    from lakeload.sinks.store import Store

    _raw_with_runs(store, spark, 10)
    load_base(store, "raw", "base")
    assert loaded_files(store, "raw").count() == 10
    assert store.read("base").count() == 9 * 9

    written = {}

    def watched(name):
        usual = getattr(Store, name)

        def run(self, table, df, *rest):
            written[table] = opened_files(df)
            return usual(self, table, df, *rest)

        monkeypatch.setattr(Store, name, run)

    watched("append_derived")
    watched("append")
    # Nothing new: nothing is read or written, though run 4 has no valid rows and no folder in base.
    load_base(store, "raw", "base")
    assert loaded_files(store, "raw").count() == 10 and written == {}
    store.append("raw", spark.range(1000, 1010, numPartitions=2).selectExpr(
        "id", "true as _is_valid", "named_struct('file_path', '/new', 'file_name', 'new', 'file_size', 1L, "
        "'file_modification_time', timestamp '2024-01-01') as _metadata"), "r10")
    written.clear()
    load_base(store, "raw", "base")
    assert loaded_files(store, "raw").count() == 11
    assert set(written) == {"base", "raw_files"}
    for files in written.values():
        assert len(files) == 2 and all("_load=run-r10" in f for f in files)
    assert store.read("base").count() == 9 * 9 + 10


def test_unfinished_parts_of_the_ledger_do_not_count(spark, store):
    from lakeload.plans.jobs import loaded_files

    _raw_with_runs(store, spark, 2)
    assert loaded_files(store, "raw").count() == 2
    # A job that stopped after it had written a part, before the note.
    store.append("raw_files", store.read("raw_files").limit(1), "stopped")
    assert loaded_files(store, "raw").count() == 2


def test_derived_runs_count_after_a_replacement(spark, store):
    store.replace("base", spark.range(3).selectExpr("id"))
    store.append_derived("base", spark.range(5, 7).selectExpr("id", "'run-x' as _load"), ["run-x"])
    assert sorted(r.id for r in store.read("base").collect()) == [0, 1, 2, 5, 6]


def test_two_writers_of_one_note(spark, store):
    import pytest

    notes, other = store.notes("t"), store.notes("t")
    notes.write("schema", {"a": 1})
    other._versions = lambda kind: []
    with pytest.raises(OSError):
        other.write("schema", {"a": 2})
    assert notes.read("schema") == {"a": 1} and notes.read("none") is None
