import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import rows
from lakeload.sinks.layout import _cuts, _rank, cluster, interleaved


def files_with(path, column, value):
    """How many of the files may hold the value, by their statistics, and how many there are."""
    held = every = 0
    for name in glob.glob(f"{path}/**/*.parquet", recursive=True):
        file = pq.ParquetFile(name)
        at = file.schema_arrow.names.index(column)
        groups = [file.metadata.row_group(g).column(at).statistics for g in range(file.metadata.num_row_groups)]
        every += len(groups)
        held += sum(s.min <= value <= s.max for s in groups)
    return held, every


def test_filters_on_each_column_skip_most_row_groups(spark, store):
    df = spark.range(40_000).select(
        (F.xxhash64("id", F.lit(1)) % 1000).alias("a"),
        F.concat(F.lit("k"), F.lpad((F.abs(F.xxhash64("id", F.lit(2))) % 1000).cast("string"), 3, "0")).alias("b"),
    )
    cluster(df, ["a", "b"], 16).write.parquet(store.path("both"))
    df.repartitionByRange(16, "a", "b").sortWithinPartitions("a", "b").write.parquet(store.path("sorted"))
    for column, value in (("a", 300), ("b", "k300"), ("a", -700), ("b", "k951")):
        held, every = files_with(store.path("both"), column, value)
        assert every == 16 and held <= 8, (column, value, held)
    assert files_with(store.path("sorted"), "b", "k300")[0] == 16  # what the second column gets without
    assert rows(spark.read.parquet(store.path("both"))) == rows(df)


def test_ranks_follow_the_order_of_values(spark):
    values = [None, -5, 0, 0, 0, 3, 3, 8, 100, 1000]
    df = spark.createDataFrame([(v,) for v in values], "v int")
    (cuts,) = _cuts(df, ["v"], 4)
    ranked = df.select("v", _rank(F.col("v"), cuts, range(4)).alias("r")).collect()
    assert all(r.r == sum(c <= r.v for c in cuts) for r in ranked if r.v is not None)
    assert [r.r for r in ranked if r.v is None] == [0] and max(r.r for r in ranked) <= 3


def test_bits_are_taken_in_turn(spark):
    df = spark.range(16).select((F.col("id") % 4).alias("x"), F.floor(F.col("id") / 4).alias("y"))
    got = {(r.x, r.y): r.z for r in df.select("x", "y", interleaved(df, ["x", "y"], bits=2).alias("z")).collect()}
    assert got == {
        (x, y): (x >> 1 & 1) << 3 | (y >> 1 & 1) << 2 | (x & 1) << 1 | (y & 1) for x in range(4) for y in range(4)
    }


@pytest.mark.parametrize("size", [0, 1, 50])
def test_any_values(spark, store, size):
    """Nulls, NaN, dates, decimals, one frequent value, names with dots and few or no rows."""
    df = spark.range(size).selectExpr(
        "if(id % 3 = 0, null, date_add(date'2024-01-01', cast(id as int))) as `d.d`",
        "if(id % 4 = 0, double('nan'), id / 7) as f", "cast(id % 2 as decimal(10,2)) as p", "7 as same",
    )
    clustered = cluster(df, ["d.d", "f", "p", "same"], 3)
    assert rows(clustered.selectExpr("`d.d`", "cast(f as string)", "p", "same")) == rows(
        df.selectExpr("`d.d`", "cast(f as string)", "p", "same")
    )


def test_a_frequent_pair_of_values_fills_several_files(spark):
    df = spark.range(20_000).selectExpr("if(id % 3 = 0, id, 5) as a", "if(id % 3 = 0, id % 7, 1) as b", "id")
    sizes = [r[1] for r in cluster(df, ["a", "b"], 8).groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 2 * 20_000 / 8


def test_within_partitions(spark, store):
    df = spark.range(3000).selectExpr("id", "id % 3 as part", "id % 50 as a", "id % 41 as b")
    store.append("t", df.drop("part"), partition_by={"part": F.col("id") % 3}, cluster_by=["a", "b"])
    assert rows(store.read("t").select("id", "part")) == rows(df.select("id", "part"))
