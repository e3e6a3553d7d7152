import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from control_files import DETAILS_DDL, PREFERENCES_DDL, write_all
from lakeload.plans.jobs import load_base, load_current, load_history, load_raw
from lakeload.sinks.layout import cluster
from lakeload.sinks import scratch
from lakeload.sinks.scratch import clear_scratch, scratch_dir
from lakeload.sinks.store import Store
from lakeload.sources import CONTROL_CSV, HEADER_FOOTER_SCHEMA, landing_glob


def test_repeated_run_replaces_itself(spark, store):
    store.append("t", spark.range(5), "one")
    store.append("t", spark.range(5), "one")
    store.append("t", spark.range(3), "two")
    assert store.read("t").count() == 8
    assert store.read_run("t", "two").count() == 3
    store.view("t", "some_view")
    assert spark.sql("select count(*) from some_view").first()[0] == 8


def test_runs_have_their_own_names(spark, store):
    assert store.append("t", spark.range(1)) != store.append("t", spark.range(1))
    assert store.read("t").count() == 2


def test_runs_named_by_dates_or_numbers(spark, store):
    for run in ("20240101", "2024-01-02", "one", "007"):
        store.append("t", spark.range(2), run)
        assert store.read_run("t", run).count() == 2
    assert store.read("t").count() == 8
    assert dict(store.read_with_runs("t").dtypes)["_load"] == "string"


def test_ensure(spark, store):
    assert not store.exists("hf")
    store.ensure("hf", HEADER_FOOTER_SCHEMA)
    store.ensure("hf", HEADER_FOOTER_SCHEMA)
    assert store.read("hf").schema.simpleString() == HEADER_FOOTER_SCHEMA.simpleString()
    assert store.read("hf").count() == 0


def test_schema_evolution(spark, store):
    store.append("t", spark.range(2))
    wider = spark.range(2).withColumn("x", F.lit("new"))
    store.append("t", wider)
    merged = store.read("t")
    assert rows(merged) == [(0, "new"), (0, None), (1, "new"), (1, None)]
    assert rows(store.read("t", schema=wider.schema)) == rows(merged)


def test_stream_and_batch_appends_are_both_read(spark, store, tmp_path):
    source = str(tmp_path / "source")
    spark.range(5).write.parquet(source)
    stream = spark.readStream.schema("id long").parquet(source)
    store.append_stream("t", stream, store.path("cp"))
    store.append("t", spark.range(3))
    assert store.read("t").count() == 8
    again = spark.readStream.schema("id long").parquet(source)
    store.append_stream("t", again, store.path("cp"))
    assert store.read("t").count() == 8


def test_replayed_batch_replaces_itself(spark, store, tmp_path):
    """Without its commit the last micro-batch runs again on restart."""
    source = str(tmp_path / "source")
    spark.range(5).write.parquet(source)
    for _ in range(2):
        stream = spark.readStream.schema("id long").parquet(source)
        store.append_stream("t", stream, store.path("cp"))
        assert store.read("t").count() == 5
        for commit in (tmp_path / "store" / "cp" / "commits").glob("*0*"):
            commit.unlink()


def test_stored_lineage_is_that_of_the_landing_files(spark, store, tmp_path):
    path = landing_glob(write_all(tmp_path, "customer_details_1"), "customer_details_1")
    load_raw(store, "raw", path, DETAILS_DDL, 7, options=CONTROL_CSV, load_date=F.lit("2023-02-01").cast("timestamp"))
    raw = store.read("raw")
    assert raw.columns[-6:] == ["_corrupt_record", "_is_valid", "_slice_date", "_process_id", "_load_date", "_metadata"]
    names = [(f"customer_details_1-2023010{d}.csv",) for d in (1, 2, 3)]
    assert rows(raw.select("_metadata.file_name").distinct()) == names
    streamed = store.read_stream("raw", raw.schema).select("_metadata.file_name")
    store.append_stream("names", streamed, store.path("cp"))
    assert rows(store.read("names").distinct()) == names
    assert rows(raw.select("_load_date").distinct()) == [(dt.datetime(2023, 2, 1),)]


@pytest.mark.parametrize("mode", ["batch", "stream"])
def test_batch_and_stream_store_the_same_rows(spark, store, tmp_path, mode):
    path = landing_glob(write_all(tmp_path, "customer_details_2"), "customer_details_2")
    how = {"load_date": F.lit("2023-02-01").cast("timestamp"), "options": CONTROL_CSV}
    load_raw(store, "batch", path, DETAILS_DDL, 1, **how)
    load_raw(store, "stream", path, DETAILS_DDL, 1, mode="stream", checkpoint=store.path("cp"), **how)
    assert rows(store.read("batch")) == rows(store.read("stream"))


def test_base_loads(spark, store, tmp_path):
    path = landing_glob(write_all(tmp_path, "customer_details_1"), "customer_details_1")
    load_raw(store, "raw", path, DETAILS_DDL, 1, options=CONTROL_CSV)
    load_base(store, "raw", "base")
    load_base(store, "raw", "base")
    assert store.read("base").count() == 34
    load_history(store, "raw", "history", ["id"], "period", except_cols=("period", "flag"))
    versions = store.read("history")
    assert versions.count() == 12  # the same details every day: one version per id
    assert versions.where("__END_AT is not null").count() == 0


def test_current_and_history_of_control_files(spark, store, tmp_path):
    """Header and footer lines stay out; the slice comes before the period, which may repeat."""
    lines = {
        "20230101": ['"H",2,20230101,b', '"I",2023-01-01 10:00:00,1,True', '"I",2023-01-01 10:00:00,2,True'],
        "20230102": ['"H",2,20230102,b', '"U",2023-01-01 10:00:00,1,False', '"D",2023-01-02 10:00:00,2,True'],
        "20230103": ['"H",1,20230103,b', '"I",2023-01-03 10:00:00,2,False'],
    }
    for day, content in lines.items():
        (tmp_path / f"p-{day}.csv").write_text("\n".join(content) + '\n"F",p,20230101\n')
    load_raw(store, "raw", str(tmp_path / "*.csv"), PREFERENCES_DDL, 1, options=CONTROL_CSV)
    sequence = ["_slice_date", "period"]
    load_current(store, "raw", "current", ["id"], sequence, "flag", except_cols=("flag", "period"))
    assert rows(store.read("current")) == [(1, False), (2, False)]
    load_history(
        store, "raw", "history", ["id"], sequence, except_cols=("flag", "period"),
        delete_when="flag = 'D'",
    )
    spans = store.read("history").selectExpr(
        "id", "contact_allowed", "day(__START_AT._slice_date)", "day(__END_AT._slice_date)"
    )
    assert rows(spans) == [(1, False, 2, None), (1, True, 1, 2), (2, False, 3, None), (2, True, 1, 2)]


def test_cluster_within_partitions(spark, store):
    df = spark.range(4000).select((F.col("id") % 2).alias("p"), F.pmod(F.hash("id"), F.lit(1000)).alias("c"))
    store.append("t", df, partition_by={"part": F.col("p")}, cluster_by=["c"])
    per_file = store.read("t").groupBy("part", "_metadata.file_name").agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
    for part in (0, 1):
        spans = sorted((r.lo, r.hi) for r in per_file.where(F.col("part") == part).collect())
        assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_cluster_gives_disjoint_files(spark, store):
    df = spark.range(4000).select(F.pmod(F.hash("id"), F.lit(1000)).alias("c"), "id")
    cluster(df, ["c"], 4).write.parquet(store.path("t"))
    spans = sorted(
        (r.lo, r.hi) for r in spark.read.parquet(store.path("t"))
        .groupBy("_metadata.file_name").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).collect()
    )
    assert len(spans) == 4
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_cluster_spreads_a_hot_value(spark, store):
    df = spark.range(4000).select(F.lit(1).alias("c"), "id")
    sizes = [r[1] for r in cluster(df, ["c"], 4).groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 2000


def test_cluster_by_load_date_needs_no_shuffle(spark, store):
    store.append("t", spark.range(10).withColumn("_load_date", F.current_timestamp()), cluster_by=["_load_date"])
    assert store.read("t").count() == 10


def test_partitioned_append(spark, store):
    df = spark.range(100).withColumn("day", F.col("id") % 5)
    store.append("t", df, partition_by={"part": F.col("day") % 2})
    table = store.read("t")
    assert table.count() == 100 and table.where("part = 1").count() == 40
    plan = table.where("part = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan


def test_scratch_dir_is_shared(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_other_format(spark, tmp_path):
    orc = Store(spark, str(tmp_path), "orc")
    orc.append("t", spark.range(4))
    assert orc.read("t").count() == 4


@pytest.mark.parametrize("names", [("a", "b"), ("b", "a")])
def test_columns_do_not_depend_on_run_names(spark, store, names):
    """A narrow and a wide run give the same columns to raw and base in either order of their names."""
    store.append("raw", spark.range(2).withColumn("_is_valid", F.lit(True)), names[0])
    load_base(store, "raw", "base")
    wide = spark.range(2, 4).withColumns({"x": F.lit("new"), "_is_valid": F.col("id") > 2})
    store.append("raw", wide, names[1])
    load_base(store, "raw", "base")
    load_base(store, "raw", "base")
    assert set(store.read("raw").columns) == {"id", "x", "_is_valid"}
    assert rows(store.read("base"), "id", "x") == [(0, None), (1, None), (3, "new")]
    assert store.read_run("raw", names[0]).columns == store.read("raw").columns
    with pytest.raises(ValueError, match="column id is bigint"):
        store.append("raw", spark.range(1).selectExpr("string(id) as id"))


def test_failed_replace_leaves_the_old_rows(spark, store):
    for n in (3, 5, 7):
        store.replace("t", spark.range(n))
        assert store.read("t").count() == n
    broken = spark.range(4).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        store.replace("t", broken)
    assert store.read("t").count() == 7
    store.replace("t", store.read("t").where("id > 1"))
    store.append("t", spark.range(1))
    assert store.read("t").count() == 6


def test_other_errors_are_not_a_missing_table(spark, store, tmp_path):
    assert not store.exists("t")
    store.append("t", spark.range(1))
    assert store.exists("t")
    (tmp_path / "store" / "u").mkdir()
    (tmp_path / "store" / "u" / "x.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="x.parquet"):
        store.exists("u")


def test_scratch_is_cleared(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scratch, "_made", [])
    path = scratch_dir(spark, "some")
    spark.range(3).write.parquet(path)
    clear_scratch(spark)
    assert not scratch._made
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
