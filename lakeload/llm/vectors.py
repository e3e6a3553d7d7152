"""Embedding near-duplicates with an inverted multi-index.

Each half of the unit vectors has a codebook of its own, learnt by k-means on a bounded sample; the two nearest
codewords name a vector's cell in the product grid. Every vector visits the cells nearest to it in the order of
the multi-sequence traversal (summed distances of the halves). How many is measured, not guessed: on sampled
vectors with partners at the threshold itself, the hardest to find, enough cells are visited for ``recall``.
Everything met is verified in double precision, so no link is below the threshold.

Cells are dealt in blocks of bounded size, visitors and members apart, so neither a crowded cell nor a
crowd of visitors meets in one task. Blocks return counts and the few edges that join the same vectors, never
all pairs. Equal vectors are one node from the start.

Vectors that are null, zero, empty, or hold nulls or non-finite numbers link with nothing. Vectors of different
length do not link. Repeated rows are vectors of their own and link with each other. A component's id is its
smallest vec_id, null only if it has no other; a row is kept if it has that id (nulls equal).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeload.llm.common import per_batch, stored
from lakeload.llm.components import components

#: Vectors that codebooks are learnt from, vectors in a cell and rows in a block on average.
SAMPLE, CELL, BLOCK = 20_000, 64, 1024
#: Sampled vectors that the number of visits is measured on.
PROBES = 1000


@dataclass
class Index:
    """Codebooks of the two halves and the number of cells to visit. Cell = first * words + second."""

    books: tuple[np.ndarray, np.ndarray]
    visits: int

    def distances(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        half = unit.shape[1] // 2
        parts = unit[:, :half], unit[:, half:]
        return tuple((b * b).sum(1) - 2 * p @ b.T for p, b in zip(parts, self.books))

    def cells(self, unit: np.ndarray) -> np.ndarray:
        """The nearest cells of each vector, nearest first."""
        first, second = self.distances(unit)
        by = np.argsort(first, axis=1, kind="stable"), np.argsort(second, axis=1, kind="stable")
        # Only the cells of ranks (i, j) with (i + 1) * (j + 1) <= visits can be among the nearest.
        i, j = (r.ravel() for r in np.indices((first.shape[1], second.shape[1])))
        near = (i + 1) * (j + 1) <= self.visits
        i, j = i[near], j[near]
        total = np.take_along_axis(first, by[0], 1)[:, i] + np.take_along_axis(second, by[1], 1)[:, j]
        best = np.argsort(total, axis=1, kind="stable")[:, : self.visits]
        pick = lambda b, r: np.take_along_axis(b[:, r], best, 1)
        return pick(by[0], i) * len(self.books[1]) + pick(by[1], j)


def _kmeans(points: np.ndarray, words: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    book = points[rng.choice(len(points), words, replace=False)].copy()
    for _ in range(rounds):
        near = ((book * book).sum(1) - 2 * points @ book.T).argmin(1)
        held = np.bincount(near, minlength=words)
        sums = np.zeros_like(book)
        np.add.at(sums, near, points)
        book[held > 0] = sums[held > 0] / held[held > 0, None]
        book[held == 0] = points[rng.choice(len(points), int((held == 0).sum()))]
    return book


def fit(sample: np.ndarray, vectors: int, cosine: float, recall: float, seed: int = 5) -> Index:
    """Codebooks for so many vectors in all, with visits measured on partners at the threshold."""
    rng = np.random.default_rng(seed)
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    half = unit.shape[1] // 2
    words = int(np.clip(np.sqrt(vectors / CELL), 1, min(256, len(unit))))
    index = Index(tuple(_kmeans(np.ascontiguousarray(p), words, rng) for p in (unit[:, :half], unit[:, half:])), 1)
    x = unit[rng.permutation(len(unit))[:PROBES]]
    aside = rng.standard_normal(x.shape)
    aside -= (aside * x).sum(1, keepdims=True) * x
    aside /= np.maximum(np.linalg.norm(aside, axis=1, keepdims=True), 1e-12)
    y = cosine * x + np.sqrt(1 - cosine**2) * aside
    rank = np.minimum(_ranks(index, x, y), _ranks(index, y, x))
    index.visits = int(np.sort(rank)[min(len(rank) - 1, int(np.ceil(recall * len(rank))))]) + 1
    return index


def _ranks(index: Index, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many cells are nearer to x than the cell of y."""
    out = []
    for s in range(0, len(x), 50):
        first, second = index.distances(x[s : s + 50])
        i, j = (d.argmin(1) for d in index.distances(y[s : s + 50]))
        rows = np.arange(len(first))
        own = (first[rows, i] + second[rows, j])[:, None, None]
        out.append((first[:, :, None] + second[:, None, :] < own).sum((1, 2)))
    return np.concatenate(out)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes with a 128-bit key; invalid ones have neither."""
    for batch in batches:
        keys, data = [], []
        column = batch.column("embedding")
        kind = np.float32 if pa.types.is_float32(column.type.value_type) else np.float64
        for row in column.to_pylist():
            vector = np.array(row, kind) if row and None not in row else None
            good = vector is not None and np.isfinite(vector).all() and np.any(vector)
            data.append(vector.astype(np.float64).tobytes() if good and kind is np.float64 else vector.tobytes() if good else None)
            keys.append(hashlib.blake2b(data[-1], digest_size=16).digest() if good else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), pa.array(keys, pa.binary()), pa.array(data, pa.binary())],
            names=["vec_id", "key", "vector"],
        )


def _units(data: list[bytes], kind: type) -> np.ndarray:
    """Unit vectors in double precision; scaled first, so that no square overflows."""
    v = np.frombuffer(b"".join(data), kind).reshape(len(data), -1).astype(np.float64)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def _indexed(indexes: dict[int, Index], kind: type):
    def make():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            data = batch.column("vector").to_pylist()
            cells: list = [None] * len(data)
            for size in {len(d) for d in data}:
                rows = [i for i, d in enumerate(data) if len(d) == size]
                for i, c in zip(rows, indexes[size].cells(_units([data[i] for i in rows], kind))):
                    cells[i] = c
            return pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("node", "times", "vector")] + [pa.array(cells, pa.list_(pa.int64()))],
                names=["node", "times", "vector", "cells"],
            )

        return each

    return per_batch(make)


def _met(cosine: float, kind: type):
    """Over rows sorted by group: links counted for each vector, and edges that join the linked ones."""

    def links(members: list[tuple], visitors: list[tuple]) -> tuple[np.ndarray, ...]:
        """Vectors and their links here, and two columns of edges."""
        m, v = _units([r[2] for r in members], kind), _units([r[2] for r in visitors], kind)
        i, j = np.nonzero(v @ m.T >= cosine)
        node = np.array([r[0] for r in visitors + members])
        other = node[i] != node[len(v) + j]
        i, j = i[other], j[other]
        if not len(i):
            return node[:0], node[:0], node[:0], node[:0]
        times = np.array([r[1] for r in visitors + members])
        home, seen = np.array([r[3][0] for r in visitors]), np.array([r[3] for r in members])
        counts = np.bincount(i, times[len(v) + j], len(node)).astype(np.int64)
        # Where the member does not come to the visitor's cell, its side of the link is counted here too.
        once = ~(home[i][:, None] == seen[j]).any(1)
        counts[len(v) :] += np.bincount(j[once], times[i[once]], len(m)).astype(np.int64)
        label, before, k = np.arange(len(node)), None, len(v) + j
        while before is None or (label != before).any():
            before = label.copy()
            np.minimum.at(label, k, label[i])
            np.minimum.at(label, i, label[k])
        held, apart = counts > 0, node[label] != node
        return node[held], counts[held], node[apart], node[label[apart]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, members, visitors = None, [], []

        def out() -> Iterator[pa.RecordBatch]:
            if members and visitors:
                node, count, a, b = links(members, visitors)
                if len(node):
                    columns = (np.concatenate([node, a]), np.concatenate([count, np.zeros_like(a)]))
                    partner = pa.array([None] * len(node) + b.tolist(), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array(c, pa.int64()) for c in columns), partner], names=["node", "links", "other"]
                    )

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("size", "cell", "x", "y", "visitor", "node", "times", "vector", "cells"))
            for *key, visitor, node, times, vector, cells in zip(*columns):
                if key != group:
                    yield from out()
                    group, members, visitors = key, [], []
                (visitors if visitor else members).append((node, times, vector, cells))
        yield from out()

    return run


def near_vectors(vectors: DataFrame, cosine: float = 0.95, recall: float = 0.99) -> DataFrame:
    """vec_id, n_links, component_id and kept for each row of ``vectors`` (vec_id, embedding)."""
    element = vectors.schema["embedding"].dataType.elementType.simpleString()
    kind = np.float32 if element == "float" else np.float64
    keyed = stored(
        vectors.select("vec_id", "embedding").mapInArrow(_keyed, "vec_id long, key binary, vector binary"), "vectors"
    )
    nodes = stored(
        keyed.filter("key is not null")
        .groupBy("key")
        .agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("times"), F.first("vector").alias("vector"))
        .withColumn("node", F.monotonically_increasing_id())
        .withColumn("size", F.octet_length("vector")),
        "vector-nodes",
    )
    indexes = {}
    for r in nodes.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect():  # lengths of vectors: a few
        sample = nodes.filter(F.col("size") == r["size"]).orderBy("key").limit(SAMPLE).select("vector").collect()
        indexes[r["size"]] = fit(_units([bytes(s["vector"]) for s in sample], kind), r["n"], cosine, recall)
    indexed = stored(
        nodes.select("node", "times", "vector").mapInArrow(
            _indexed(indexes, kind), "node long, times long, vector binary, cells array<long>"
        ),
        "indexed",
    ).withColumn("size", F.octet_length("vector"))

    met = _blocks(indexed).mapInArrow(_met(cosine, kind), "node long, links long, other long")
    met = stored(met, "vector-links")
    counts = met.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(met.filter("other is not null").select(F.col("node").alias("a"), F.col("other").alias("b")))
    found = (
        nodes.select("node", "key", "vec_id", "times")
        .join(counts, "node", "left")
        .join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
        .withColumn("links", F.coalesce("links", F.lit(0)) + F.col("times") - 1)
    )
    least = found.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    of_key = found.join(least, "root").select("key", "links", "component_id")
    return (
        keyed.select("vec_id", "key")
        .join(of_key, "key", "left")
        .select(
            "vec_id",
            F.coalesce("links", F.lit(0)).alias("n_links"),
            F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )


def _blocks(indexed: DataFrame) -> DataFrame:
    """Each vector as a member of its cell and as a visitor of the cells it visits, in blocks, sorted by group."""
    members = indexed.withColumn("cell", F.element_at("cells", 1))
    visitors = indexed.withColumn("cell", F.explode("cells"))
    number = lambda rows, name: rows.groupBy("size", "cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias(name))
    blocks = number(members, "xs").join(number(visitors, "ys"), ["size", "cell"])  # one row per cell
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ("size", "cell", "x", "y", "visitor", "node", "times", "vector", "cells")
    dealt = [
        rows.join(blocks, ["size", "cell"]).withColumn("x", x).withColumn("y", y).withColumn("visitor", F.lit(visits)).select(*columns)
        for rows, x, y, visits in ((members, own("xs"), every("ys"), False), (visitors, every("xs"), own("ys"), True))
    ]
    group = ("size", "cell", "x", "y")
    return dealt[0].unionByName(dealt[1]).repartition(*group).sortWithinPartitions(*group)
