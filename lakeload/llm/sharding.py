"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Each shard owns points on a ring of 64-bit hashes; a key belongs to the first point clockwise. A shard
takes at most its bound; keys that find it full go on clockwise to the next point of a shard with room.
Keys arrive in ring order, so the result depends on the rows alone.

Only the number of keys on each arc (points are few and fixed: shards x virtual nodes) goes to the
driver, which walks the ring once and says which ranks of an arc go to which shard. Rows never leave their
arcs: one shuffle by arc gives ranks, and the ranges are joined back as a table of that fixed size.

Rows equal in id, size and text hash are one unit with a count, so a hot id is combined before the
shuffle. A null text has size 1 and the hash of no bytes; null ids have a place on the ring as well. An
empty table gives empty shards.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeload.llm.common import repeated, stored

POINTS = 128


def ring(shards: int, points: int = POINTS) -> list[tuple[int, int]]:
    """(position, shard) of all virtual nodes in ring order; positions are signed 64-bit."""

    def at(shard: int, point: int) -> int:
        digest = hashlib.blake2b(f"{shard}/{point}".encode(), digest_size=8).digest()
        return int.from_bytes(digest, "big", signed=True)

    return sorted((at(s, k), s) for s in range(shards) for k in range(points))


def bounds(total: int, shards: int, slack: float) -> list[int]:
    """Rows a shard may hold: even shares, at most one apart, raised by ``slack``."""
    even = [total // shards + (s < total % shards) for s in range(shards)]
    return [int(e * (1 + slack)) for e in even]


def walk(nodes: list[tuple[int, int]], counts: dict[int, int], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(arc, first rank, end rank, shard, first slot) for the keys on each arc."""
    held, ranges = [0] * len(room), []
    for arc in range(len(nodes)):
        rank, end, point = 0, counts.get(arc, 0), arc
        while rank < end:
            shard = nodes[point % len(nodes)][1]
            take = min(end - rank, room[shard] - held[shard])
            if take:
                ranges.append((arc, rank, rank + take, shard, held[shard]))
                held[shard] += take
                rank += take
            point += 1
    return ranges


def _arc(position: Column, nodes: list[tuple[int, int]]) -> Column:
    """Number of the first point at or after a position, by halving; past the last one it is the first."""
    points = F.array(*[F.lit(p) for p, _ in nodes])
    steps = F.sequence(F.lit(1), F.lit(max(1, len(nodes)).bit_length()))
    middle = lambda s: F.floor((s["lo"] + s["hi"]) / 2).cast("int")

    def halve(s: Column, _: Column) -> Column:
        before = F.element_at(points, middle(s) + 1) < position
        return F.when(s["lo"] >= s["hi"], s).otherwise(
            F.struct(
                F.when(before, middle(s) + 1).otherwise(s["lo"]).alias("lo"),
                F.when(before, s["hi"]).otherwise(middle(s)).alias("hi"),
            )
        )

    found = F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.lit(len(nodes)).alias("hi")), halve, lambda s: s["lo"])
    return F.pmod(found, F.lit(len(nodes)))


def assign(
    spark: SparkSession, rows: DataFrame, keys: list[str], shards: int, slack: float = 0.0, points: int = POINTS
) -> DataFrame:
    """``keys``, shard and slot (gapless from 0 in each shard) for each row.

    With ``slack`` 0 the shards' counts are at most one apart. More slack moves fewer rows when the number of
    shards changes, and no shard exceeds its even share by more than that part.
    """
    nodes = ring(shards, points)
    units = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).withColumn("_at", F.xxhash64(*keys))
    units = stored(units.withColumn("_arc", _arc(F.col("_at"), nodes)), "ring-units")
    counts = {r["_arc"]: r["n"] for r in units.groupBy("_arc").agg(F.sum("_n").alias("n")).collect()}
    ranges = walk(nodes, counts, bounds(sum(counts.values()), shards, slack))
    placed = spark.createDataFrame(ranges, "_arc int, _from long, _to long, shard int, _slot long")
    order = Window.partitionBy("_arc").orderBy("_at", *keys)
    ranked = units.withColumn("_end", F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    ranked = ranked.withColumn("_first", F.col("_end") - F.col("_n"))
    # At most shards x points + shards ranges, however many rows there are.
    within = (F.col("_from") < F.col("_end")) & (F.col("_to") > F.col("_first"))
    low, high = F.greatest("_from", "_first"), F.least("_to", "_end")
    met = (
        ranked.join(F.broadcast(placed), "_arc")
        .filter(within)
        .withColumn("_count", high - low)
        .withColumn("_slot", F.col("_slot") + low - F.col("_from"))
    )
    return repeated(met, "_count", "_i").select(*keys, "shard", (F.col("_slot") + F.col("_i")).alias("slot"))


def _size() -> Column:
    return (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long")


def _crc() -> Column:
    return F.crc32(F.coalesce(F.col("text").cast("binary"), F.lit(b""))).cast("long")


def document_keys(docs: DataFrame) -> DataFrame:
    """doc_id, size in UTF-8 bytes plus 1, crc32 of the text."""
    return docs.select("doc_id", _size().alias("size"), _crc().alias("text_crc32"))


def write_shards(docs: DataFrame, assignment: DataFrame, path: str) -> None:
    """Write the documents as ``path/shard=<s>``, files and rows in slot order."""
    size, crc = _size(), _crc()
    same = Window.partitionBy("doc_id", "_size", "_crc")
    keyed = docs.withColumn("_size", size).withColumn("_crc", crc).withColumn("_i", F.row_number().over(same.orderBy("text")))
    each = Window.partitionBy("doc_id", "size", "text_crc32").orderBy("shard", "slot")
    slots = assignment.withColumn("_i", F.row_number().over(each))
    on = (
        keyed["doc_id"].eqNullSafe(slots["doc_id"])
        & (keyed["_size"] == slots["size"])
        & (keyed["_crc"] == slots["text_crc32"])
        & (keyed["_i"] == slots["_i"])
    )
    (
        keyed.join(slots, on)
        .select(*[keyed[c] for c in docs.columns], "shard", "slot")
        .repartitionByRange("shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .write.partitionBy("shard")
        .parquet(path)
    )
