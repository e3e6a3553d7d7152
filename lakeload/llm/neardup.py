"""MinHash near-duplicates: one-permutation hashing, optimal densification, star-shaped candidates.

A document's set is its distinct shingles of ``words`` words (lower-cased A-Z). One hash of each shingle picks
a bin and a value; the least value of each bin is the sketch, and an empty bin borrows from a non-empty one by
a random order that depends on the bin alone. Bands of the sketch are buckets. In each bucket the document
with most company is the centre, and only (centre, member) pairs are candidates: a bucket of k documents
gives k - 1 pairs. Links are confirmed on the full sets of shingle hashes (64 bits).

A star leaves pairs of two members untested. Those only matter where a member turned out not to belong to its
centre's component. Such outsiders are compared, in blocks, with everything that shares that centre, so every
two documents that share a bucket are either in one component or have been compared.

With the default 40 bands of 5 rows a pair at the threshold of 0.8 shares no bucket with a probability of
1.2e-7; more similar pairs are missed less often.

Documents with the same words in the same order are one node from the start. Null, empty and blank texts have
no shingles and link with nothing. A document with fewer words than a shingle has its whole sequence as one.
Repeated rows are equal documents. A component's id is its smallest doc_id, null only if it has no other; a
row is kept if it has that id (nulls equal).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.llm.common import fresh, per_batch, stored, utf8
from lakeload.llm.components import components


@dataclass(frozen=True)
class Near:
    """Words in a shingle, least similarity in percent, bands and rows of the sketch."""

    words: int = 5
    percent: int = 80
    bands: int = 40
    rows: int = 5


#: Words whose hashes a task remembers, and shingles in a block of documents compared at once, on average.
REMEMBERED, BLOCK = 300_000, 1_000_000
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


class Hasher:
    """Shingle hashes of texts; hashes of words are remembered up to a bound."""

    def __init__(self, words: int):
        self.words, self.known = words, {}

    def _codes(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for w in set(words).difference(known):
            known[w] = xxhash.xxh64_digest(w)
        return np.frombuffer(b"".join(map(known.__getitem__, words)), np.uint64)

    def shingles(self, text: bytes | None) -> np.ndarray:
        """The set of shingle hashes in ascending order."""
        words = (text or b"").lower().split()
        if not words:
            return np.empty(0, np.uint64)
        codes, k = self._codes(words), min(self.words, len(words))
        found = np.full(len(codes) - k + 1, k, np.uint64)
        for j in range(k):
            found = _mix(found * _A + codes[j : len(codes) - k + 1 + j])
        return np.unique(found)


class Sketcher:
    """One-permutation sketches of sets of hashes, and their bands."""

    def __init__(self, near: Near):
        self.near, self.bins = near, near.bands * near.rows
        self.order = np.random.default_rng(20).permuted(
            np.tile(np.arange(self.bins, dtype=np.uint16), (self.bins, 1)), axis=1
        )

    def bands(self, found: np.ndarray) -> np.ndarray:
        bins = ((found >> np.uint64(32)) * np.uint64(self.bins) >> np.uint64(32)).astype(np.int64)
        first = np.flatnonzero(np.diff(bins, prepend=-1))  # hashes ascend, so the first in a bin is its least
        full = bins[first]
        sketch = np.empty(self.bins, np.uint64)
        sketch[full] = found[first]
        if len(full) < self.bins:
            empty = np.setdiff1d(np.arange(self.bins), full, assume_unique=True)
            sketch[empty] = found[first][self.order[np.ix_(empty, full)].argmin(axis=1)]
        rows = sketch.reshape(self.near.bands, self.near.rows)
        keys = np.arange(self.near.bands, dtype=np.uint64) + np.uint64(1)
        for r in range(self.near.rows):
            keys = _mix(keys * _A + rows[:, r])
        return keys.view(np.int64)


def fingerprint(text: Column) -> Column:
    """128 bits of the lower-cased words in order, without regard to the space between them."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    flat = F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")
    return F.unhex(F.md5(F.translate(F.trim(flat), upper, lower).cast("binary")))


def _sketches(near: Near):
    def make():
        hasher, sketcher = Hasher(near.words), Sketcher(near)

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            sizes, keys = [], []
            for text in utf8(batch.column("text")):
                found = hasher.shingles(text)
                sizes.append(len(found))
                keys.append(sketcher.bands(found) if len(found) else None)
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("fp"), pa.array(sizes, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "fp", "n_shingles", "keys"],
            )

        return each

    return per_batch(make)


def _sets(near: Near):
    def make():
        hasher = Hasher(near.words)

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            sets = [hasher.shingles(t).tobytes() for t in utf8(batch.column("text"))]
            return pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.binary())], names=["node", "set"])

        return each

    return per_batch(make)


def _alike(common: np.ndarray, a: int, b: np.ndarray, percent: int) -> np.ndarray:
    return 100 * common >= percent * (a + b - common)


def _linked_pairs(percent: int):
    def make():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            keep, last, centre = [], None, None
            for i, (x, y) in enumerate(zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist())):
                if x is not last and x != last:
                    last, centre = x, np.frombuffer(x, np.uint64)
                other = np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(centre, other, assume_unique=True))
                if _alike(common, len(centre), len(other), percent):
                    keep.append(i)
            return batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

        return each

    return per_batch(make)


def _linked_blocks(percent: int):
    """Over rows sorted by group: links between its outsiders and its members, as few as join the same nodes."""

    def links(rows: list[tuple]) -> list[tuple[int, int]]:
        outside = [r for r in rows if r[3]]
        inside = [r for r in rows if not r[3]]
        if not outside or not inside:
            return []
        every = np.concatenate([np.frombuffer(r[1], np.uint64) for r in outside + inside])
        size = np.array([len(r[1]) // 8 for r in outside + inside])
        known, number = np.unique(every, return_inverse=True)
        ends = np.cumsum(size)
        first = ends[len(outside) - 1]
        starts, members = ends[len(outside) - 1 : -1] - first, number[first:]
        root = {r[0]: r[2] for r in rows}

        def top(x: int) -> int:
            while root.get(x, x) != x:
                x = root[x]
            return x

        found, held = [], np.zeros(len(known), np.int64)
        for i, (node, *_) in enumerate(outside):
            own = number[ends[i] - size[i] : ends[i]]
            held[own] = 1
            common = np.add.reduceat(held[members], starts)
            held[own] = 0
            for j in np.flatnonzero(_alike(common, size[i], size[len(outside) :], percent)):
                a, b = top(node), top(inside[j][0])
                if a != b:
                    root[max(a, b)] = min(a, b)
                    found.append((node, inside[j][0]))
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows = None, []

        def out() -> Iterator[pa.RecordBatch]:
            if pairs := links(rows):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*pairs)], names=["a", "b"]
                )

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("centre", "x", "y", "node", "set", "root", "outsider"))
            for centre, x, y, *row in zip(*columns):
                if (centre, x, y) != group:
                    yield from out()
                    group, rows = (centre, x, y), []
                rows.append(tuple(row))
        yield from out()

    return run


def near_duplicates(docs: DataFrame, near: Near = Near()) -> DataFrame:
    """doc_id, fp (fingerprint), n_shingles, component_id, root and kept for each row of ``docs`` (doc_id, text).

    ``root`` tells components apart, also those without an id; it is null for rows without shingles.
    """
    texted = docs.select("doc_id", "text", fingerprint(F.col("text")).alias("fp"))
    sketched = stored(
        texted.mapInArrow(_sketches(near), "doc_id long, fp binary, n_shingles long, keys array<long>"), "sketches"
    )
    # One node for each text; ids given once and stored.
    nodes = stored(
        sketched.filter("n_shingles > 0")
        .groupBy("fp")
        .agg(F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n"), F.first("keys").alias("keys"))
        .withColumn("node", F.monotonically_increasing_id()),
        "nodes",
    )
    banded = nodes.select("node", "n", F.explode("keys").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("held")).filter("held > 1")
    members = stored(banded.join(shared, "bucket"), "members")
    company = members.groupBy("node").agg(F.sum("held").alias("company"))
    centres = (
        members.join(company, "node")
        .groupBy("bucket")
        .agg(F.max(F.struct("company", (-F.col("node")).alias("minus"), F.col("n").alias("n_centre"))).alias("c"))
        .select("bucket", (-F.col("c.minus")).alias("centre"), "c.n_centre")
    )
    stars = stored(
        members.join(centres, "bucket")
        .filter("node <> centre")
        .groupBy("centre", "node")
        .agg(F.first("n").alias("n"), F.first("n_centre").alias("n_centre")),
        "stars",
    )
    involved = stars.select("node").unionByName(stars.select(F.col("centre").alias("node"))).distinct()
    wanted = involved.join(nodes, "node").select("node", "doc_id", "fp")
    texts = (
        texted.alias("d")
        .join(wanted.alias("w"), F.expr("d.fp = w.fp and d.doc_id <=> w.doc_id"))
        .select("node", "text")
    )
    sets = stored(texts.mapInArrow(_sets(near), "node long, set binary"), "sets").dropDuplicates(["node"])
    sets = stored(sets, "sets")

    possible = f"100 * least(n, n_centre) >= {near.percent} * greatest(n, n_centre)"
    pairs = (
        stars.filter(possible)
        .select(F.col("centre").alias("a"), F.col("node").alias("b"))
        .join(sets.select(F.col("node").alias("b"), F.col("set").alias("set_b")), "b")
        .join(sets.select(F.col("node").alias("a"), F.col("set").alias("set_a")), "a")
    )
    links = stored(pairs.mapInArrow(_linked_pairs(near.percent), "a long, b long"), "links")
    roots = components(links)
    more = stored(_outsiders(stars, sets, roots, near), "more-links")
    if more.limit(1).count():
        # What is joined already needs no further rounds: a node and its root stand for all their links.
        joined = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
        roots = components(joined.unionByName(more))
    roots = stored(roots, "roots")

    of_node = nodes.select("node", "fp", "doc_id").join(roots, "node", "left").withColumn(
        "root", F.coalesce("root", "node")
    )
    least = of_node.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of_text = of_node.join(least, "root").select("fp", "component_id", "root")
    found = sketched.select("doc_id", "fp", "n_shingles").join(of_text, "fp", "left")
    alone = F.col("n_shingles") == 0
    return found.select(
        "doc_id",
        "fp",
        "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        "root",
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def without_copies(docs: DataFrame, near: Near = Near()) -> DataFrame:
    """One row of each component, that of the smallest doc_id, and every row without words; columns as they are."""
    kept = near_duplicates(docs, near).filter("kept and root is not null")
    kept = stored(kept.groupBy("root").agg(F.min(F.struct("doc_id", "fp")).alias("k"), F.count(F.lit(1)).alias("n")), "kept")
    one = kept.select("k.doc_id", "k.fp")
    (fp,) = fresh(docs, "fp")
    blank = F.coalesce(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(True))
    texted = docs.filter(~blank).withColumn(fp, fingerprint(F.col("text")))
    stay = texted.join(one, texted["doc_id"].eqNullSafe(one["doc_id"]) & (texted[fp] == one["fp"]), "left_semi")
    if kept.filter("n > 1").limit(1).count():
        stay = stay.dropDuplicates(["doc_id", fp])
    return stay.drop(fp).unionByName(docs.filter(blank))


def _outsiders(stars: DataFrame, sets: DataFrame, roots: DataFrame, near: Near) -> DataFrame:
    """Links found by comparing members outside their centre's component with all that share the centre.

    Outsiders and members of a centre are dealt to blocks by their numbers of shingles, and each two blocks
    meet in a group of their own.
    """
    of = roots.select("node", "root")
    rooted = (
        stars.join(of, "node", "left")
        .join(of.select(F.col("node").alias("centre"), F.col("root").alias("centre_root")), "centre", "left")
        .withColumn("root", F.coalesce("root", "node"))
        .withColumn("outsider", F.col("root") != F.coalesce("centre_root", "centre"))
    )
    # Read twice below; stored, so that neither plan grows large.
    rooted = stored(rooted.select("centre", "node", "n", "root", "outsider"), "rooted")
    blocks = (
        rooted.groupBy("centre")
        .agg(
            F.ceil(F.sum(F.when(F.col("outsider"), F.col("n"))) / BLOCK).cast("int").alias("xs"),
            F.ceil(F.sum("n") / BLOCK).cast("int").alias("ys"),
            F.count(F.lit(1)).alias("all"),
        )
        .filter("xs > 0 and all > 1")
    )
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    group = lambda x, y, outsider: F.struct(x.alias("x"), y.alias("y"), F.lit(outsider).alias("outsider"))
    every = lambda n, of: F.transform(F.sequence(F.lit(0), F.col(n) - 1), of)
    outside = F.when(F.col("outsider"), every("ys", lambda y: group(own("xs"), y, True)))
    inside = every("xs", lambda x: group(x, own("ys"), False))
    met = rooted.join(blocks, "centre").select(
        "centre", "node", "root", F.inline(F.concat(F.coalesce(outside, F.array()), inside))
    )
    return (
        met.select("centre", "x", "y", "node", "root", "outsider")
        .join(sets, "node")
        .repartition("centre", "x", "y")
        .sortWithinPartitions("centre", "x", "y", "node")
        .mapInArrow(_linked_blocks(near.percent), "a long, b long")
    )
