"""Running a stream until everything available is processed."""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


STATE_PARTITIONS = "spark.sql.shuffle.partitions"
_starting = threading.Lock()


def run_available(
    spark: SparkSession, writer: DataStreamWriter, checkpoint: str, state_partitions: int | None = None
) -> StreamingQuery:
    """Start with the ``availableNow`` trigger and wait; an error in the stream is raised here.

    ``state_partitions`` sizes the state of a stream that joins or aggregates. A checkpoint keeps
    the number of its first run, so it is set here per stream instead of per session.
    """
    with _starting:  # one at a time, so that streams started side by side keep their own numbers
        usual = spark.conf.get(STATE_PARTITIONS)
        if state_partitions is not None:
            spark.conf.set(STATE_PARTITIONS, state_partitions)
        try:
            query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        finally:
            spark.conf.set(STATE_PARTITIONS, usual)
    query.awaitTermination()
    return query


def query_id(batch: DataFrame) -> str:
    """Inside ``foreachBatch``: the stream's id, which stays the same across restarts."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
