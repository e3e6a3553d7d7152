import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lakeload.operators.cdc import END, START, scd2
from lakeload.operators.splice import Splicer
from lakeload.plans.jobs import read_spliced, splice_history

CHANGES = "k long, t long, v string, note string"


def made(spark, seed, n=400, keys=12):
    rng = random.Random(seed)
    data = [
        (rng.choice([None, *range(keys)]), rng.choice([None, *range(60)]), rng.choice(["a", "b", None, "gone"]), f"n{rng.randrange(3)}")
        for _ in range(n)
    ]
    return spark.createDataFrame(data, CHANGES)


HOW = {"except_cols": ("note",), "delete_when": "v = 'gone'"}


@pytest.mark.parametrize("order", ["random", "ascending", "late"])
def test_steps_as_one_history(spark, store, order):
    changes = made(spark, 3)
    step = {
        "random": F.pmod(F.xxhash64("k", "t", "v", "note"), F.lit(4)),
        "ascending": F.floor(F.coalesce("t", F.lit(0)) / 15),
        "late": F.when(F.col("t") < 20, 2).when(F.col("t") < 40, 0).otherwise(1),
    }[order]
    dealt = changes.withColumn("step", step)
    for i in range(4):
        store.append("raw", dealt.where(F.col("step") == i).drop("step"))
        splice_history(store, "raw", "base", ["k"], "t", tie_cols=("v",), buckets=3, **HOW)
        so_far = store.read("raw")
        wanted = scd2(so_far, ["k"], "t", tie_cols=("v",), **HOW)
        assert rows(read_spliced(store, "base", ["k"], "t"), "k", "t", "v", START, END) == rows(wanted, "k", "t", "v", START, END)


def test_one_change_at_a_time(spark):
    """Every order of a few changes of one key, from no spans on."""
    how = Splicer(["k"], "t", ("note",), delete_when="v = 'gone'")
    rng = random.Random(8)
    for _ in range(6):
        data = [(1, t, rng.choice(["a", "b", "gone"]), "n") for t in rng.sample(range(9), 5)]
        spans = None
        for i, one in enumerate(data):
            df = spark.createDataFrame([one], CHANGES)
            spans = how.splice(spans, df, lambda i=i: spark.createDataFrame(data[: i + 1], CHANGES))
            spans = spark.createDataFrame(spans.collect(), spans.schema)
        wanted = scd2(spark.createDataFrame(data, CHANGES), ["k"], "t", except_cols=("note",), delete_when="v = 'gone'")
        assert rows(how.versions(spans, ["k", "t", "v"]), "k", "v", START, END) == rows(wanted, "k", "v", START, END)


def test_the_log_is_read_only_for_changes_inside_spans(spark):
    how = Splicer(["k"], "t")
    df = lambda *data: spark.createDataFrame(list(data), "k long, t long, v string")

    def never():
        raise AssertionError("the log was read")

    spans = how.splice(None, df((1, 10, "a"), (1, 20, "a"), (1, 30, "b"), (2, 5, "x")), never)
    spans = spark.createDataFrame(spans.collect(), spans.schema)
    # Before, after, between two spans, and inside one in its own state.
    late = how.splice(spans, df((1, 5, "b"), (1, 25, "c"), (1, 15, "a"), (1, 40, "b")), never)
    assert [(r.v, r[START], r[END]) for r in how.versions(late, ["v"]).orderBy(START).collect()] == [
        ("b", 5, 10), ("a", 10, 25), ("c", 25, 30), ("b", 30, None),
    ]
    asked = []
    every = df((1, 10, "a"), (1, 20, "a"), (1, 30, "b"), (2, 5, "x"), (1, 15, "z"))
    late = how.splice(spans, df((1, 15, "z")), lambda: asked.append(1) or every)
    assert [(r.v, r[START], r[END]) for r in how.versions(late, ["v"]).orderBy(START).collect()] == [
        ("a", 10, 15), ("z", 15, 20), ("a", 20, 30), ("b", 30, None),
    ]
    assert asked == [1]


def test_other_buckets_stay(spark, store):
    data = [(k, 1, "a", "n") for k in range(40)]
    store.append("raw", spark.createDataFrame(data, CHANGES))
    splice_history(store, "raw", "base", ["k"], "t", buckets=8)
    first = store.notes("base").read("history")["holds"]
    store.append("raw", spark.createDataFrame([(7, 2, "b", "n")], CHANGES))
    splice_history(store, "raw", "base", ["k"], "t", buckets=8)
    second = store.notes("base").read("history")["holds"]
    assert sum(first[b] != second[b] for b in first) == 1
    splice_history(store, "raw", "base", ["k"], "t", buckets=8)
    assert store.notes("base").read("history")["holds"] == second
    assert read_spliced(store, "base", ["k"], "t").count() == 41
