"""A session set up for these loads. They run in any other session too."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Re-plan at run time: join strategy, skewed joins and writes, partition sizes.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Slice dates and timestamps without a zone mean the same on every cluster.
    "spark.sql.session.timeZone": "UTC",
    # Landing files in windows-1252.
    "spark.sql.legacy.javaCharsets": "true",
    # State of the header/footer join on local disk instead of the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
}


def session(app: str = "lakeload", master: str | None = None, **settings: str) -> SparkSession:
    """Get or create the session; ``settings`` use ``__`` for the dots of a setting's name."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    chosen = {**SETTINGS, **{k.replace("__", "."): v for k, v in settings.items()}}
    for name, value in chosen.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
