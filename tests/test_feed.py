import pytest

from conftest import rows
from lakeload.operators.feed import change_feed
from lakeload.operators.stage import inserted_rows
from lakeload.plans.jobs import table_changes


def test_changes_by_key(spark):
    before = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (None, "n"), (5, "gone")], "k int, v string")
    after = spark.createDataFrame([(1, "a"), (2, "c"), (3, None), (None, "m"), (6, None)], "k int, v string")
    found = rows(change_feed(before, after, ["k"], "r1"))
    assert found == sorted([
        (2, "b", "update_preimage", "r1"), (2, "c", "update_postimage", "r1"), (None, "n", "update_preimage", "r1"),
        (None, "m", "update_postimage", "r1"), (5, "gone", "delete", "r1"), (6, None, "insert", "r1"),
    ], key=repr)
    assert rows(inserted_rows(change_feed(before, after, ["k"], "r1"))) == [(6, None)]


def test_empty_states_and_new_columns(spark):
    some = spark.createDataFrame([(1, "a")], "k int, v string")
    none = some.limit(0)
    assert rows(change_feed(none, some, ["k"], "r")) == [(1, "a", "insert", "r")]
    assert rows(change_feed(some, none, ["k"], "r")) == [(1, "a", "delete", "r")]
    wider = spark.createDataFrame([(1, "a", None)], "k int, v string, w int")
    assert rows(change_feed(some, wider, ["k"], "r")) == []


def test_stored_table(spark, store):
    with pytest.raises(ValueError):
        store.read_before("t")
    one = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    store.replace("t", one)
    store.replace("t", one.where("k = 2"))
    store.append("t", spark.createDataFrame([(3, "c")], "k int, v string"), "later")
    made = store.runs("t")
    feed = rows(table_changes(store, "t", ["k"]))
    assert [(r[0], r[2]) for r in feed] == [(1, "delete"), (3, "insert")]
    assert feed[1][3] == "run-later" and feed[0][3] in made and feed[0][3] != "run-later"
