import datetime as dt

from conftest import rows
from lakeload.operators.quality import (
    check_constraints,
    check_unique,
    distinct_rows,
    duplicate_keys,
    split_constraints,
)
from lakeload.operators.stage import inserted_rows, retain, split_valid
from lakeload.plans.jobs import build_customers

DATA = [(1, "a", 5), (1, "b", None), (2, "a", -1), (None, "a", 3), (None, "a", 3)]
DDL = "id int, code string, amount int"


def test_duplicate_keys(spark):
    df = spark.createDataFrame(DATA, DDL)
    assert rows(duplicate_keys(df, ["id"])) == [(1, 2), (None, 2)]
    assert rows(duplicate_keys(df, ["id", "code"])) == [(None, "a", 2)]


def test_check_unique(spark):
    df = spark.createDataFrame(DATA, DDL)
    assert rows(check_unique(df, ["id", "code"])) == [(5, 4, 1, False)]
    assert rows(check_unique(df.distinct(), ["id", "code"])) == [(4, 4, 0, True)]
    assert rows(check_unique(df.limit(0), ["id"])) == [(0, 0, 0, True)]


def test_constraints(spark):
    df = spark.createDataFrame(DATA, DDL)
    rules = {"positive": "amount > 0", "has_id": "id is not null"}
    assert rows(check_constraints(df, rules)) == [
        ("has_id", "id is not null", 5, 2), ("positive", "amount > 0", 5, 2)
    ]
    good, bad = split_constraints(df, rules)
    assert good.count() + bad.count() == 5
    assert rows(bad, "id", "_failed") == [
        (1, ["positive"]), (2, ["positive"]), (None, ["has_id"]), (None, ["has_id"])
    ]


def test_distinct_rows(spark):
    df = spark.createDataFrame(DATA, DDL)
    assert distinct_rows(df).count() == 4
    assert rows(distinct_rows(df, ["code"])) == [("a",), ("b",)]


def test_split_valid(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, _is_valid boolean")
    good, bad = split_valid(df)
    assert (rows(good, "id"), rows(bad, "id")) == ([(1,)], [(2,), (3,)])


def test_inserted_rows(spark):
    feed = spark.createDataFrame(
        [(1, "insert", 1), (2, "delete", 2), (3, "update_postimage", 2)],
        "id int, _change_type string, _commit_version long",
    )
    assert rows(inserted_rows(feed)) == [(1,)]


def test_retain(spark):
    days = [(dt.datetime(2023, 1, d),) for d in (1, 5, 10)]
    df = spark.createDataFrame(days, "_slice_date timestamp")
    assert retain(df, 5).count() == 2
    assert retain(df, 5, dt.datetime(2023, 1, 6)).count() == 3
    assert retain(df, 5, "2023-01-11").count() == 1
    assert retain(df.limit(0), 5).count() == 0


def test_customers(spark):
    one = spark.createDataFrame([(1, "a", 10.0)], "id int, name string, amount double")
    two = spark.createDataFrame([(2, "b", 20.0), (3, "c", 1.5)], "id int, name string, amount double")
    preferences = spark.createDataFrame([(1, True), (3, False), (9, True)], "id int, contact_allowed boolean")
    assert rows(build_customers([one, two], preferences)) == [
        (1, "a", 10.0, True), (2, "b", 20.0, None), (3, "c", 1.5, False)
    ]
