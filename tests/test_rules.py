import pytest
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import functions as F

from conftest import rows
from lakeload.sinks.store import BrokenRules

RULES = {"small": "id < 10", "named": "name is not null"}


def some(spark, *ids):
    return spark.createDataFrame([(i, f"n{i}" if i >= 0 else None) for i in ids], "id long, name string")


def test_a_broken_run_changes_no_readers_rows(spark, store):
    store.append("t", some(spark, 1), "one")
    store.constrain("t", RULES)
    store.append("t", some(spark, 2, 3), "two")
    reader, schema = store.read("t"), store.schema("t")
    with pytest.raises(BrokenRules, match="small fails on 2 rows, named fails on 1 rows") as broken:
        store.append("t", some(spark, 4, 10, 11, -1).withColumn("more", F.lit(1)), "three")
    assert broken.value.failed == {"small": 2, "named": 1} and broken.value.runs == ["run-three"]
    for seen in (reader, store.read("t")):
        assert rows(seen, "id") == [(1,), (2,), (3,)]
    assert store.schema("t") == schema and store.runs("t") == ["run-one", "run-two"]
    aside = store.left_aside("t", "three")
    assert rows(aside, "id", "_failed") == [(-1, ["named"]), (10, ["small"]), (11, ["small"])]
    store.append("t", some(spark, 4), "three")  # mended
    assert rows(store.read("t"), "id") == [(1,), (2,), (3,), (4,)]


def test_a_run_that_is_there_stays_when_its_repetition_is_refused(spark, store):
    store.constrain("t", RULES)
    store.append("t", some(spark, 1, 2), "one")
    with pytest.raises(BrokenRules):
        store.append("t", some(spark, 99), "one")
    assert rows(store.read("t"), "id") == [(1,), (2,)]
    store.append("t", some(spark, 3), "one")
    assert rows(store.read("t"), "id") == [(3,)]


def test_rows_there_are_checked_and_rules_can_be_lifted(spark, store):
    store.append("t", some(spark, 1, 12))
    with pytest.raises(BrokenRules, match="small fails on 1 rows"):
        store.constrain("t", RULES)
    assert store.rules("t") == {}
    store.constrain("t", {"small": "id < 20"})
    with pytest.raises(BrokenRules):
        store.append("t", some(spark, 20))
    store.constrain("t", {})
    store.append("t", some(spark, 20))
    assert rows(store.read("t"), "id") == [(1,), (12,), (20,)]


def test_a_rule_on_an_absent_column_fails_before_the_write(spark, store):
    store.constrain("t", {"x": "x > 0"})
    with pytest.raises(AnalysisException):
        store.append("t", some(spark, 1))
    assert not store.exists("t")


def test_replacements_and_derived_runs_are_checked(spark, store):
    store.append("t", some(spark, 1), "one")
    store.constrain("t", RULES)
    with pytest.raises(BrokenRules):
        store.replace("t", some(spark, 50))
    assert rows(store.read("t"), "id") == [(1,)]
    store.replace("t", some(spark, 5))
    assert rows(store.read("t"), "id") == [(5,)] and rows(store.read_before("t"), "id") == [(1,)]
    store.constrain("d", RULES)
    runs = ["run-a", "run-b"]
    store.append_derived("d", some(spark, 1, 2).withColumn("_load", F.format_string("run-%s", F.when(F.col("id") == 1, "a").otherwise("b"))), runs)
    with pytest.raises(BrokenRules):
        store.append_derived("d", some(spark, 3, 77).withColumn("_load", F.lit("run-c")), ["run-c"])
    store.append_derived("d", some(spark).withColumn("_load", F.lit("run-e")), ["run-e"])
    assert rows(store.read("d"), "id") == [(1,), (2,)]


def test_streams_stop_at_a_broken_batch_and_readers_of_the_table_see_none_of_it(spark, store):
    store.constrain("t", RULES)
    some(spark, 1, 2).write.parquet(store.path("landing"))

    def load():
        store.append_stream("t", spark.readStream.schema("id long, name string").parquet(store.path("landing")), store.path("cp"))

    load()
    some(spark, 3, 30).write.mode("append").parquet(store.path("landing"))
    with pytest.raises(StreamingQueryException, match="small fails on 1 rows"):
        load()
    assert rows(store.read("t"), "id") == [(1,), (2,)]
    seen = store.read_stream("t")
    store.append_stream("seen", seen, store.path("cp2"))
    assert rows(store.read("seen"), "id") == [(1,), (2,)]


def test_partitions_of_a_run_and_empty_runs(spark, store):
    store.constrain("t", RULES)
    store.append("t", some(spark, 1, 2, 3), partition_by={"odd": F.col("id") % 2})
    store.append("t", some(spark), partition_by={"odd": F.col("id") % 2})
    assert rows(store.read("t").select("id", "odd")) == [(1, 1), (2, 0), (3, 1)]
