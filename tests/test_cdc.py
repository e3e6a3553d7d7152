"""Type 1 and type 2 results against plain Python over small random change sets."""

import datetime as dt
import itertools

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import rows
from lakeload.operators.cdc import END, START, apply_cdc, as_of, history, scd2, unsequenced

DDL = "k string, seq int, sub int, value string, other int, op string"
SETTINGS = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)

change = st.tuples(
    st.sampled_from(["a", "b", None]),
    st.one_of(st.none(), st.integers(0, 8)),
    st.integers(0, 2),
    st.sampled_from(["x", "y", None]),
    st.integers(0, 1),
    st.sampled_from(["I", "U", "D"]),
)
changes = st.lists(change, min_size=1, max_size=40)


def nulls_first(values):
    return tuple((v is not None, v) for v in values)


@pytest.fixture(scope="module")
def tie_hash(spark):
    """The hash that orders ties, for every value and other of the change sets."""
    df = spark.createDataFrame(
        [(v, o) for v in ("x", "y", None) for o in (0, 1)], "value string, other int"
    )
    return {(r[0], r[1]): r[2] for r in df.select("*", F.xxhash64("value", "other")).collect()}


def brute_scd2(data, deletes, tie_hash):
    """(k, value, other, start, end) with sequence (seq, sub); op only marks deletes."""
    out = []
    by_key = {}
    for r in data:
        if r[1] is not None:
            by_key.setdefault(r[0], []).append(r)
    for key, group in by_key.items():
        group.sort(key=lambda r: (r[1], r[2], deletes and r[5] == "D", tie_hash[r[3], r[4]]))
        states = []
        for r in group:
            state = None if deletes and r[5] == "D" else (r[3], r[4])
            if not states or states[-1][0] != state:
                states.append((state, (r[1], r[2])))
        for (state, start), following in itertools.zip_longest(states, states[1:]):
            if state is not None:
                out.append((key, *state, start, following[1] if following else None))
    return sorted(out, key=repr)


def spark_scd2(df, deletes, **how):
    result = scd2(
        df, ["k"], ["seq", "sub"], except_cols=("seq", "sub", "op"),
        delete_when="op = 'D'" if deletes else None, **how,
    )
    got = result.select("k", "value", "other", START, END).collect()
    return sorted(
        ((r[0], r[1], r[2], tuple(r[3]), tuple(r[4]) if r[4] else None) for r in got), key=repr
    )


@pytest.mark.parametrize("deletes", [False, True])
@SETTINGS
@given(data=changes)
def test_scd2_matches_brute_force(spark, tie_hash, deletes, data):
    df = spark.createDataFrame(data, DDL)
    wanted = brute_scd2(data, deletes, tie_hash)
    assert spark_scd2(df, deletes, split_rows=None) == wanted
    # Keys over 3 rows are cut into pieces: the same history, also with every row twice.
    assert spark_scd2(df, deletes, split_rows=3) == wanted
    assert spark_scd2(df.unionByName(df), deletes, split_rows=1) == wanted


def test_scd2_one_hot_key(spark):
    """One key holds nearly all rows and is cut into many pieces."""
    df = spark.range(30_000).selectExpr(
        "if(id % 100 = 0, cast(id as string), 'hot') as k",
        "cast(hash(id) as int) as seq", "cast(id % 7 as int) as sub",
        "cast(pmod(id, 3) as string) as value", "cast(pmod(id, 2) as int) as other", "'U' as op",
    )
    whole = spark_scd2(df, False, split_rows=None)
    assert len(whole) > 20_000
    assert spark_scd2(df, False, split_rows=200) == whole


def test_scd2_copies_of_one_row(spark):
    """Copies fill a key: they collapse, and cut points cannot separate them."""
    df = spark.range(5_000).selectExpr(
        "'k' as k", "if(id < 4900, 5, cast(id as int)) as seq", "0 as sub",
        "cast(if(id < 4900, 0, id) as string) as value", "0 as other", "'U' as op",
    )
    whole = spark_scd2(df, False, split_rows=None)
    assert len(whole) == 101
    assert spark_scd2(df, False, split_rows=50) == whole


def test_scd2_ties_of_a_hot_key(spark):
    """Different rows at one moment: content orders them, and can cut them too."""
    df = spark.range(4_000).selectExpr(
        "'k' as k", "if(id < 3900, 5, cast(id as int)) as seq", "0 as sub",
        "cast(id as string) as value", "0 as other", "'U' as op",
    )
    whole = spark_scd2(df, False, split_rows=None)
    assert len(whole) == 4_000
    assert spark_scd2(df.orderBy(F.rand(3)), False, split_rows=100) == whole


@SETTINGS
@given(data=changes, seed=st.randoms())
def test_scd2_intervals(spark, data, seed):
    shuffled = list(data)
    seed.shuffle(shuffled)
    versions = spark_scd2(spark.createDataFrame(data, DDL), False)
    assert versions == spark_scd2(spark.createDataFrame(shuffled, DDL), False)
    for _, group in itertools.groupby(versions, key=lambda v: v[0]):
        spans = sorted(((v[3], v[4]) for v in group), key=lambda s: (s[0], s[1] is None, s[1] or s[0]))
        assert [s[1] for s in spans].count(None) == 1
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


@SETTINGS
@given(data=changes)
def test_apply_cdc_matches_brute_force(spark, data):
    last = {}
    for r in data:
        if r[1] is not None:
            place = nulls_first((r[1], r[2], r[3], r[4], r[5]))
            if r[0] not in last or place > last[r[0]][0]:
                last[r[0]] = (place, r)
    wanted = sorted((r for _, r in last.values() if r[5] != "D"), key=repr)
    df = spark.createDataFrame(data, DDL)
    assert rows(apply_cdc(df, ["k"], ["seq", "sub"], "op")) == wanted


def test_sequence_by_slice_then_period(spark):
    """An update may repeat an old period; the slice it came in decides."""
    day1, day2 = dt.datetime(2023, 1, 1), dt.datetime(2023, 1, 2)
    df = spark.createDataFrame(
        [(8, "I", day1, day1, True), (8, "U", day2, day1, False), (3, "I", day1, day1, True), (3, "D", day2, day2, True)],
        "id int, flag string, _slice_date timestamp, period timestamp, allowed boolean",
    )
    current = apply_cdc(df, ["id"], ["_slice_date", "period"], "flag", except_cols=("flag",))
    assert rows(current, "id", "allowed") == [(8, False)]
    assert "flag" not in current.columns


def test_reinserted_key_is_current(spark):
    df = spark.createDataFrame([(6, 1, "I"), (6, 2, "D"), (6, 3, "I"), (7, 1, "I"), (7, 2, "D")], "id int, seq int, op string")
    assert rows(apply_cdc(df, ["id"], "seq", "op"), "id", "seq") == [(6, 3)]
    versions = scd2(df.withColumn("v", df.id), ["id"], "seq", ("seq", "op"), delete_when="op = 'D'")
    assert rows(versions, "id", START, END) == [(6, 1, 2), (6, 3, None), (7, 1, 2)]


def test_balances(spark):
    """Composite key, late rows, one exact copy, and tracked columns without the sequence."""
    start = dt.datetime(2023, 1, 1, 5, 54, 12)
    days = [start + dt.timedelta(days=d) for d in range(7)]
    amounts = ["36.6608", "20.9508", "73.1040", "24.5350", "40.3144", "44.1501", "11.6329"]
    data = [(t, t, "13", "c", a) for t, a in zip(days, amounts)]
    data = data[3:] + [data[2]] + data[:3] + [(days[0], days[5], "14", "c", "1.0000")]
    df = spark.createDataFrame(data, "transacted timestamp, created timestamp, id string, code string, amount string")
    df = df.withColumn("amount", df.amount.cast("decimal(10,4)"))
    result = scd2(df, ["id", "code"], "created", except_cols=("created",))
    assert result.columns == ["transacted", "id", "code", "amount", START, END]
    versions = history(result, {"id": "13", "code": "c"}).collect()
    assert [str(v.amount) for v in versions] == amounts
    assert [v[START] for v in versions] == days
    assert [v[END] for v in versions] == days[1:] + [None]
    open_then = as_of(result, "2023-01-03 12:00:00")
    assert rows(open_then, "id", "amount")[0][1] == versions[2].amount and open_then.count() == 1
    assert as_of(result, "2023-01-06 05:54:12").count() == 2


def test_unsequenced(spark):
    df = spark.createDataFrame([("a", None), ("b", 1)], "k string, seq int")
    assert rows(unsequenced(df, "seq")) == [("a", None)]
    assert rows(scd2(df.withColumn("v", df.k), ["k"], "seq"), "k") == [("b",)]
