"""Type 2 history kept up to date from a change stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from lakeload.operators.cdc import SPLIT_ROWS, scd2
from lakeload.operators.skew import same_keys
from lakeload.sinks.scratch import scratch_dir
from lakeload.sinks.store import Store
from lakeload.streaming.run import query_id, run_available

BUCKET = "_bucket"


def stream_scd2(
    store: Store,
    changes: DataFrame,
    log: str,
    target: str,
    checkpoint: str,
    keys: list[str],
    sequence_by: str | list[str],
    except_cols: tuple[str, ...] = (),
    tie_cols: tuple[str, ...] = (),
    delete_when: str | None = None,
    track_cols: list[str] | None = None,
    buckets: int = 64,
    split_rows: int | None = SPLIT_ROWS,
) -> None:
    """Apply all available changes to the history table ``target``.

    Changes are appended to the table ``log``, partitioned by a hash bucket of the key. Then the keys of this
    micro-batch are computed anew from the log, so late rows of any age fall into place; the other keys of
    their buckets are taken from ``target`` as they are, and together they replace those partitions. Other
    buckets are neither read nor written. A replayed micro-batch replaces its own log rows and arrives at the
    same history; until its write has ended, readers may see the touched buckets in part.
    Choose ``buckets`` so that one is a few hundred megabytes; a hot key inside a bucket is split. The number
    is kept with the log, and another one is refused.
    """
    spark = store.spark
    _fix_buckets(store, log, buckets)
    logged = StructType([
        *changes.schema.fields,
        StructField("_batch", StringType()),
        StructField(BUCKET, IntegerType()),
    ])

    def update(batch: DataFrame, batch_id: int) -> None:
        name = f"stream-{query_id(batch)}-{batch_id}"
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
        (
            batch.withColumn(BUCKET, bucket)
            .hint("rebalance", F.col(BUCKET))
            .write.format(store.fmt)
            .mode("overwrite")
            .partitionBy(BUCKET)
            .save(f"{store.path(log)}/_batch={name}")
        )
        table = spark.read.schema(logged).format(store.fmt).load(store.path(log))
        # At most `buckets` small numbers, taken from partition names.
        seen = table.where(F.col("_batch") == name).select(BUCKET).distinct()
        touched = [r[0] for r in seen.collect()]
        if not touched:
            return
        rows = table.where(F.col(BUCKET).isin(touched))
        own = rows.where(F.col("_batch") == name).select(*keys, BUCKET).distinct()
        same = same_keys("r", "k", [*keys, BUCKET])
        changed = rows.drop("_batch").alias("r").join(own.alias("k"), same, "left_semi")
        versions = scd2(
            changed, [*keys, BUCKET], sequence_by, except_cols, tie_cols, delete_when,
            track_cols, split_rows,
        )
        if (before := store.read_files(target)) is not None:
            others = before.where(F.col(BUCKET).isin(touched)).alias("r").join(own.alias("k"), same, "left_anti")
            versions = versions.unionByName(others, allowMissingColumns=True)
        # The partitions to be replaced are read first, so the result is written out before.
        path = scratch_dir(spark, "history")
        versions.write.parquet(path)
        (
            spark.read.schema(versions.schema).parquet(path).hint("rebalance", F.col(BUCKET))
            .write.format(store.fmt)
            .mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BUCKET)
            .save(store.path(target))
        )

    run_available(spark, changes.writeStream.foreachBatch(update), checkpoint)


def _fix_buckets(store: Store, log: str, buckets: int) -> None:
    """Keep the number of buckets with the log; refuse another one than it was written with."""
    path = f"{store.path(log)}/_buckets"
    kept = store.read_files(f"{log}/_buckets", "text")
    if kept is not None and (row := kept.head()):
        if int(row[0]) != buckets:
            raise ValueError(f"{log} has {row[0]} buckets, not {buckets}")
        return
    store.spark.createDataFrame([(str(buckets),)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_history(store: Store, target: str) -> DataFrame:
    return store.spark.read.format(store.fmt).load(store.path(target)).drop(BUCKET)
