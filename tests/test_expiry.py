import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from conftest import rows
from lakeload.operators.stage import retain
from lakeload.plans.jobs import expire_raw, load_raw, loaded_files


def days(spark, first, last, kind="timestamp"):
    """A row for each day of 2024 from ``first`` to ``last``, numbered."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int"))
    return spark.range(first, last + 1).select("id", day.cast(kind).alias("_slice_date"))


def break_files(store, run):
    """Make a run's files unreadable: a scan that opens one fails."""
    found = glob.glob(f"{store.path('t')}/_load={run}/*.parquet")
    assert found
    for name in found:
        os.remove(f"{os.path.dirname(name)}/.{os.path.basename(name)}.crc")
        with open(name, "wb") as f:
            f.write(b"not a table")


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date"])
def test_same_rows_as_the_filter(spark, store, kind):
    for first in (0, 10, 20):
        store.append("t", days(spark, first, first + 9, kind), f"from-{first}")
    gone = store.expire("t", 12)
    assert gone == ["run-from-0"] and store.runs("t") == ["run-from-10", "run-from-20"]
    assert rows(store.read("t")) == rows(retain(days(spark, 0, 29, kind), 12))
    assert store.read("t").count() == 13


def test_known_and_expired_runs_are_not_opened(spark, store):
    store.append("t", days(spark, 0, 9), "old")
    store.append("t", days(spark, 10, 19), "kept")
    assert store.expire("t", 30) == []
    break_files(store, "run-old")
    break_files(store, "run-kept")
    store.append("t", days(spark, 20, 25), "new")
    # Both old runs are known, so only the new one is opened; the reader opens what is left.
    assert store.expire("t", 5) == ["run-kept", "run-old"]
    assert sorted(r.id for r in store.read("t").collect()) == list(range(20, 26))
    # The next call deletes what the last one let go, and no more.
    assert os.path.exists(f"{store.path('t')}/_load=run-old")
    assert store.expire("t", 5) == []
    assert not os.path.exists(f"{store.path('t')}/_load=run-old")
    assert store.read("t").count() == 6


def test_bound_is_pushed_to_the_scan(spark, store):
    store.append("t", days(spark, 0, 29), "one")
    store.expire("t", 3)
    plan = store.read("t")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(_slice_date" in plan


def test_bound_never_moves_back_and_holds_for_late_rows(spark, store):
    store.append("t", days(spark, 0, 29), "one")
    store.expire("t", 3)
    store.append("t", days(spark, 5, 5), "late")
    assert store.read("t").count() == 4
    assert store.expire("t", 100) == ["run-late"]
    assert store.read("t").count() == 4
    store.replace("t", days(spark, 0, 29))
    assert store.read("t").count() == 30


def test_a_run_written_again_is_looked_at_again(spark, store):
    store.append("t", days(spark, 0, 5), "one")
    store.append("t", days(spark, 20, 25), "two")
    assert store.expire("t", 10) == ["run-one"]
    store.append("t", days(spark, 21, 24), "one")
    assert store.runs("t") == ["run-one", "run-two"] and store.read("t").count() == 10
    assert store.expire("t", 10) == [] and store.read("t").count() == 10


def test_moment_given_empty_runs_and_rows_without_a_value(spark, store):
    store.append("t", days(spark, 0, 29), "one")
    store.append("t", days(spark, 0, 0).where("false"), "empty")
    store.append("t", days(spark, 0, 0).withColumn("_slice_date", F.lit(None).cast("timestamp")), "null")
    assert store.expire("t", 10, dt.datetime(2024, 1, 21)) == ["run-empty", "run-null"]
    assert store.read("t").count() == 20
    assert store.expire("t", 0, "2030-01-01") == ["run-one"]
    assert store.read("t").count() == 0 and store.read("t").columns == ["id", "_slice_date"]
    assert store.expire("t", 0) == []


def test_span_does_not_depend_on_the_time_zone(spark, store):
    zone = spark.conf.get("spark.sql.session.timeZone")
    store.append("t", days(spark, 0, 9), "one")
    store.append("t", days(spark, 10, 19), "two")
    store.expire("t", 30)
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert store.expire("t", 9) == ["run-one"]
        assert store.read("t").count() == 10
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_refusals(spark, store):
    with pytest.raises(ValueError, match="not a table"):
        store.expire("t", 1)
    store.append("t", days(spark, 0, 9).withColumn("other", F.col("_slice_date")), "one")
    with pytest.raises(ValueError, match="not by a bigint"):
        store.expire("t", 1, column="id")
    store.expire("t", 1)
    with pytest.raises(ValueError, match="expire by _slice_date"):
        store.expire("t", 1, column="other")


def test_expired_files_are_not_loaded_again(spark, store, tmp_path):
    for day in ("20240101", "20240109", "20240110"):
        (tmp_path / f"t-{day}.csv").write_text("1\n2\n")
    schema = spark.createDataFrame([], "v string, _corrupt_record string").schema
    load = lambda: load_raw(store, "raw", f"{tmp_path}/t-*.csv", schema, 1)
    load()
    assert expire_raw(store, "raw", 5) == []
    assert store.read("raw").count() == 4
    (tmp_path / "t-20240102.csv").write_text("1\n")
    load()
    load()
    assert loaded_files(store, "raw").count() == 4
    assert store.read_with_runs("raw", bounded=False).count() == 7
    assert store.read("raw").count() == 4
    assert store.schema("raw")["v"].dataType == StringType()
