"""Mixing sources to target weights by pivotal dependent rounding.

Every document gets a fractional number of copies, the same for all of its source, so that the source's
words meet its target. The whole part is taken as it is. The rest is a probability; two documents of a
source meet, words are moved from one to the other at random, without bias, until one of them is whole.
Each meeting keeps the words of the pair, so a source stays on its target through the whole reduction.
What is left fractional in a leaf goes up a tree of fixed fan-in, and the last one of a source goes to its
nearer whole number: a source ends within half of one document of its target. Documents meet from long to
short, so that the one left over is short.

Rows: null and empty texts have size 0 and take 0 words. A null source is a source of its own, ordered
last. Rows equal in id, source and size are one unit with a count and share its copies evenly, so a
hot id is combined before any shuffle. An empty table gives an empty mix.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeload.llm.common import fresh, levels, repeated, stored, word_count

#: Units in a leaf of the tree on average, and leaves that meet in one node above.
LEAF, FAN_IN = 4096, 64
#: A probability this close to 0 or 1 is whole.
NEAR = 1e-9


def source_targets(units: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: float = 3.0) -> DataFrame:
    """One row per source with its size, number of units and target.

    Sources in code point order, null last, take the weights in turn and share the size of everything; a
    target stops at ``most`` times its source, and the excess goes to the others by weight. The two windows
    run over one row per source.
    """
    sizes = units.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"), F.count(F.lit(1)).alias("units")
    )
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighed = sizes.withColumn("weight", F.element_at(cycle, (turn % len(weights) + 1).cast("int"))).withColumn(
        "cap", most * F.col("source_size")
    )
    # With sources by cap per weight, those below the water level are full; the rest share what remains.
    by = Window.orderBy((F.col("cap") / F.col("weight")), F.col("source").asc_nulls_last())
    full = F.coalesce(F.sum("cap").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(by.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(Window.partitionBy())
    leveled = weighed.withColumn("level", (total - full) / open_weight)
    water = F.max(F.when(F.col("cap") / F.col("weight") >= F.col("level"), F.col("level"))).over(Window.partitionBy())
    return leveled.withColumn("target", F.least(F.col("cap"), water * F.col("weight"))).select(
        "source", "source_size", "units", F.coalesce("target", F.lit(0.0)).alias("target")
    )


def _meet(a: float, p: float, b: float, q: float, draw: float) -> tuple[float, float]:
    """New probabilities of two documents of sizes a and b; a*p + b*q stays, one becomes whole."""
    up, down = min(a * (1 - p), b * q), min(a * p, b * (1 - q))
    if draw * (up + down) < down:
        return p + up / a, q - up / b
    return p - down / a, q + down / b


def _pivot(seed: int, level: int):
    """Over rows sorted by source and node: all become whole but for one in each node at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, left, rng = object(), None, random.Random()
        schema = None
        for batch in batches:
            schema, out = batch.schema, []
            at = {k: i for i, k in enumerate(schema.names)}
            source, node, size, p = at["source"], at["node"], at["size"], at["p"]
            for row in map(list, zip(*(c.to_pylist() for c in batch.columns))):
                if (row[source], row[node]) != group:
                    group = (row[source], row[node])
                    rng.seed(f"{seed}|{level}|{row[source] is None}|{row[source]}|{row[node]}")
                    out += [left] if left else []
                    left = row
                    continue
                if left is None:
                    left = row
                    continue
                left[p], row[p] = _meet(left[size], left[p], row[size], row[p], rng.random())
                still = None
                for x in (left, row):
                    if NEAR < x[p] < 1 - NEAR and still is None:
                        still = x
                    else:
                        x[p] = float(round(x[p]))
                        out.append(x)
                left = still
            if out:
                yield _batch(out, schema)
        if left:
            yield _batch([left], schema)

    return run


def _batch(rows: list[list], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), schema)], schema=schema)


def mix(
    docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), most: float = 3.0, seed: int = 7
) -> DataFrame:
    """Copies for each row of ``docs`` (doc_id, text, source).

    Returns doc_id, source, size (words), n (equal rows), i (number among them), source_size, target and
    copies. The result depends on the rows and the seed alone.
    """
    units = stored(
        docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
        .groupBy("doc_id", "source", "size")
        .agg(F.count(F.lit(1)).alias("n")),
        "mix-units",
    )
    sources = stored(source_targets(units, weights, most), "mix-sources")
    largest = sources.agg(F.max("units")).head()[0] or 0
    share = F.least(F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")), F.lit(most))
    wanted = F.col("n") * F.coalesce(share, F.lit(0.0))
    spread = F.xxhash64(F.lit(seed), "doc_id", "size", "n")
    planned = (
        units.join(sources, units["source"].eqNullSafe(sources["source"]))
        .select("doc_id", units["source"], "size", "n", "units", wanted.alias("wanted"), spread.alias("spread"))
        .withColumn("base", F.floor(F.col("wanted") + NEAR))
        .withColumn("p", F.greatest(F.col("wanted") - F.col("base"), F.lit(0.0)))
    )
    # Without words there is nothing to move: such a row is rounded by its own draw.
    alone = (F.col("size") == 0) & (F.pmod(F.col("spread"), F.lit(1 << 20)) < F.col("p") * (1 << 20))
    planned = planned.withColumn(
        "p", F.when(F.col("size") == 0, alone.cast("double")).when(F.col("p") <= NEAR, 0.0).otherwise(F.col("p"))
    ).withColumn("node", F.pmod(F.col("spread"), F.ceil(F.col("units") / LEAF)).cast("long"))
    columns = ("doc_id", "source", "size", "n", "base", "spread", "node", "p")
    planned = stored(planned.select(*columns), "mix-planned")
    fractional = (F.col("p") > NEAR) & (F.col("p") < 1 - NEAR)
    done, open_ = [planned.filter(~fractional)], planned.filter(fractional)
    for level in range(levels(-(-largest // LEAF), FAN_IN)):
        met = stored(
            open_.repartition("source", "node")
            .sortWithinPartitions("source", "node", F.col("size").desc(), "spread", "doc_id")
            .mapInArrow(_pivot(seed, level), open_.schema),
            "mix-level",
        )
        done.append(met.filter(~fractional))
        open_ = met.filter(fractional).withColumn("node", F.floor(F.col("node") / FAN_IN))
    whole = open_.withColumn("p", F.round("p"))
    for part in done:
        whole = whole.unionByName(part)
    total = F.col("base") + F.col("p").cast("long")
    placed = repeated(whole.withColumn("total", total), "n", "i").withColumn(
        "copies", F.floor(F.col("total") / F.col("n")) + (F.col("i") < F.col("total") % F.col("n")).cast("long")
    )
    return placed.join(sources, placed["source"].eqNullSafe(sources["source"])).select(
        "doc_id", placed["source"], "size", "n", "i", "source_size", "target", "copies"
    )


def mixed_documents(docs: DataFrame, mixture: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as the mixture says; columns as in ``docs``."""
    size, number, copies, again = fresh(docs, "size", "i", "copies", "again")
    keyed = docs.withColumn(size, word_count(F.col("text")))
    if mixture.filter(F.col("n") > 1).limit(1).count():
        same = Window.partitionBy("doc_id", "source", size).orderBy("text")
        keyed = keyed.withColumn(number, F.row_number().over(same) - 1)
    else:
        keyed = keyed.withColumn(number, F.lit(0))
    m = mixture.filter(F.col("copies") > 0)
    on = (
        keyed["doc_id"].eqNullSafe(m["doc_id"])
        & keyed["source"].eqNullSafe(m["source"])
        & (keyed[size] == m["size"])
        & (keyed[number] == m["i"])
    )
    matched = keyed.join(m, on).select(*[keyed[c] for c in docs.columns], m["copies"].alias(copies))
    return matched.withColumn(again, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int")))).drop(copies, again)
