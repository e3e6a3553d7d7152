"""Tables written by the loads."""

from lakeload.sinks.layout import cluster
from lakeload.sinks.scratch import clear_scratch, scratch_dir
from lakeload.sinks.store import Store

__all__ = ["Store", "clear_scratch", "cluster", "scratch_dir"]
