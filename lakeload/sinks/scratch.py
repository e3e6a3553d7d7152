"""Where intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


_made: list[str] = []


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh directory under the shared folder in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        _made.append(f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}")
        return _made[-1]
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    _made.append(tempfile.mkdtemp(prefix=f"run-{name}-") + "/data")
    return _made[-1]


def clear_scratch(spark: SparkSession) -> None:
    """Delete the directories given out in this process. Results that still read them must be written before."""
    files = spark._jvm.org.apache.hadoop.fs
    while _made:
        path = files.Path(_made.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
