"""Connected components of a table of edges, for near-duplicate groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lakeload.llm.common import stored


def _kept(edges: DataFrame) -> tuple[DataFrame, tuple[int, int]]:
    """The edges as written, with their number and a sum over their hashes, both taken while they are written."""
    seen = Observation()
    told = (F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b") % (1 << 40)).alias("h"))
    now = stored(edges.observe(seen, *told), "edges")
    return now, (seen.get["n"], seen.get["h"] or 0)


def _pairs(*pairs: tuple[str, str]) -> Column:
    """The pairs of columns as an array, for ``inline``."""
    return F.array(*(F.struct(F.col(a).alias("a"), F.col(b).alias("b")) for a, b in pairs))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge; edges have long columns a and b, the root is the smallest node.

    Alternates two star steps until nothing changes. Each node hands the smallest neighbour to the others, by
    an aggregation and a join over one exchange, so no neighbourhood is held in memory. Every round is one job of
    three exchanges, written to the shared folder; its plan stays small, as the driver keeps a copy of each plan
    for each of its stages. An edge found twice counts once from the next round on.
    """
    now, state = _kept(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before = None
    while state != before:
        # Each node's larger neighbours move to its smallest neighbour ...
        both = now.select(F.inline(_pairs(("a", "b"), ("b", "a")))).repartition("a")
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).repartition("a")
        # ... and then it and its smaller neighbours do.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.inline(_pairs(("b", "m"), ("a", "m")))).filter("a <> b")
        before, (now, state) = state, _kept(small.distinct())
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
