"""Incremental forms of the loads, run to completion with ``availableNow``."""
