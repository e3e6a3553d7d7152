import itertools

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from lakeload.sinks.types import wider

KINDS = ["tinyint", "smallint", "int", "bigint", "float", "double", "decimal(6,2)", "decimal(20,4)", "string", "date"]
pytestmark = pytest.mark.usefixtures("spark")
VALUES = {
    "float": "1.5", "double": "0.1", "decimal(6,2)": "1234.56",
    "decimal(20,4)": "1234567890123456.1234", "string": "'x'", "date": "date'2024-01-02'",
}


def kind(ddl):
    return T.StructType.fromDDL(f"c {ddl}").fields[0].dataType


@pytest.mark.parametrize(
    ("a", "b", "both"),
    [
        ("int", "bigint", "bigint"), ("tinyint", "smallint", "smallint"), ("float", "double", "double"),
        ("int", "float", "double"), ("bigint", "double", None), ("decimal(6,2)", "decimal(10,4)", "decimal(10,4)"),
        ("int", "decimal(6,2)", "decimal(12,2)"), ("decimal(38,0)", "decimal(38,10)", None), ("int", "string", None),
        ("array<int>", "array<bigint>", "array<bigint>"), ("map<string,int>", "map<string,double>", "map<string,double>"),
        ("struct<x:int,y:string>", "struct<x:bigint,y:string>", "struct<x:bigint,y:string>"),
        ("struct<x:int>", "struct<y:int>", None),
    ],
)
def test_wider(a, b, both):
    for x, y in ((a, b), (b, a)):
        found = wider(kind(x), kind(y))
        assert (found and found.simpleString()) == both


def test_one_lattice():
    """The order of the runs does not matter, and what is wider than both holds each."""
    for a, b, c in itertools.product(map(kind, KINDS), repeat=3):
        ab, ba = wider(a, b), wider(b, a)
        assert ab == ba
        if ab is not None:
            assert wider(a, ab) == wider(b, ab) == ab


@pytest.mark.parametrize("vectorized", ["true", "false"])
def test_old_runs_are_read_as_the_wider_type(spark, store, vectorized):
    """Every widening, by both Parquet readers, in both orders of writing."""
    spark.conf.set("spark.sql.parquet.enableVectorizedReader", vectorized)
    try:
        pairs = [(a, b, w) for a, b in itertools.permutations(KINDS, 2) if (w := wider(kind(a), kind(b)))]

        def one_row(chosen):
            cells = (f"cast({VALUES.get(k, '7')} as {k}) as c{i}" for i, k in enumerate(chosen))
            return spark.sql(f"select {', '.join(cells)}")

        one, two = one_row([a for a, _, _ in pairs]), one_row([b for _, b, _ in pairs])
        store.append("t", one, "b")
        store.append("t", two, "a")
        merged = store.read("t")
        assert [f.dataType for f in merged.schema] == [w for _, _, w in pairs]
        cast = [F.col(f"c{i}").cast(w).alias(f"c{i}") for i, (_, _, w) in enumerate(pairs)]
        assert rows(merged) == rows(one.select(*cast).union(two.select(*cast)))
    finally:
        spark.conf.unset("spark.sql.parquet.enableVectorizedReader")


def test_other_types_are_refused_before_rows_are_written(spark, store):
    store.append("t", spark.range(2), "one")
    with pytest.raises(ValueError, match="column id is bigint, not string"):
        store.append("t", spark.sql("select 'x' as id"), "two")
    assert rows(store.read("t")) == [(0,), (1,)] and store.runs("t") == ["run-one"]


def test_nested_columns_widen(spark, store):
    store.append("t", spark.sql("select named_struct('x', 1) as s, array(1) as a, map('k', 1) as m"))
    store.append("t", spark.sql("select named_struct('x', 2L) as s, array(2L) as a, map('k', 2L) as m"))
    assert store.read("t").schema.simpleString() == "struct<s:struct<x:bigint>,a:array<bigint>,m:map<string,bigint>>"
    assert rows(store.read("t").selectExpr("s.x", "a[0]", "m['k']")) == [(1, 1, 1), (2, 2, 2)]
