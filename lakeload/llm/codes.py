"""Vectors as short codes: parts of integer vectors and the nearest entry of each part's codebook.

Nearest entries are found without floating point. Parts and entries, padded with zeros to a power of two, are
transformed by the integer Walsh-Hadamard matrix, which multiplies every squared distance by the padded length.
Squared differences are added up in sequency order, some coefficients at a time; an entry whose sum already
exceeds another entry's whole distance is out. Sums only grow, so the nearest entry is never lost, and ties go to
the lower index.

Rows whose vector is null, empty, or holds nulls or non-finite numbers are dropped. So are rows whose vector has
another length than that of the smallest vec_id, and those with a component too large for exact long integers (over
16,000 in vectors of 64). A length that is no multiple of the parts is padded with zeros. The codebooks start from the smallest
vec_ids, nulls last, vectors deciding among equal ids; with fewer rows the codebooks are smaller. Repeated rows are
rows of their own. Other columns are not read, whatever their names. An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.llm.common import per_batch, short_batches, stored

#: Coefficients that are added up before entries are compared again, and rows that are compared at a time.
STEP, ROWS_AT_ONCE = 4, 256
#: Labels whose sums are broadcast; with more, both sides are shuffled over this many places for each label.
LABELS, SALTS = 100_000, 32


@dataclass(frozen=True)
class Coding:
    scale: int = 1024
    parts: int = 4
    entries: int = 256
    rounds: int = 4


def sequency(length: int) -> np.ndarray:
    """The Walsh-Hadamard matrix of a power of two, rows by their number of sign changes."""
    h = np.ones((1, 1), np.int64)
    while len(h) < length:
        h = np.block([[h, h], [h, -h]])
    return h[np.argsort((np.diff(h, axis=1) != 0).sum(1), kind="stable")]


def transformed(parts: np.ndarray) -> np.ndarray:
    """Rows of integers, padded to a power of two, by the matrix."""
    width = 1 << max(0, parts.shape[1] - 1).bit_length()
    padded = np.zeros((len(parts), width), np.int64)
    padded[:, : parts.shape[1]] = parts
    return padded @ sequency(width).T


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(lowest index of a nearest entry, squared distance) for each row, exactly."""
    index, far = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
    entries = transformed(book)
    width = entries.shape[1]
    for s in range(0, len(parts), ROWS_AT_ONCE):
        rows = transformed(parts[s : s + ROWS_AT_ONCE])
        some = slice(s, s + len(rows))
        sums = ((rows[:, None, :STEP] - entries[None, :, :STEP]) ** 2).sum(2)
        # The whole distance of the entry that leads so far bounds the least one.
        bound = ((rows - entries[sums.argmin(1)]) ** 2).sum(1)
        row, entry = np.nonzero(sums <= bound[:, None])
        total = sums[row, entry]
        for c in range(STEP, width, STEP):
            total = total + ((rows[row, c : c + STEP] - entries[entry, c : c + STEP]) ** 2).sum(1)
            left = total <= bound[row]
            row, entry, total = row[left], entry[left], total[left]
        # Rows and their entries ascend, so the first least one of a row has the lowest index.
        starts = np.searchsorted(row, np.arange(len(rows)))
        least = np.minimum.reduceat(total, starts)
        first = np.flatnonzero(total == least[row])
        first = first[np.unique(row[first], return_index=True)[1]]
        index[some], far[some] = entry[first], least // width
    return index, far


def most_exact(length: int, how: Coding) -> int:
    """Integers up to this one, either sign, leave every transformed distance below 2 to the 62nd power."""
    width = 1 << max(0, -(-length // how.parts) - 1).bit_length()
    return int((2.0**62 / (4.0 * width**3)) ** 0.5)


def integers(rows: DataFrame, how: Coding = Coding()) -> DataFrame:
    """vec_id, label and the integers of each vector that is kept, padded to a multiple of the parts."""
    good = F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.forall(
        "embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False))
    )
    scaled = rows.filter(good).select(
        "vec_id", "label", F.transform("embedding", lambda x: F.floor(x.cast("double") * how.scale).cast("double")).alias("scaled")
    )
    first = scaled.orderBy(F.col("vec_id").asc_nulls_last(), "scaled").select(F.size("scaled")).first()
    length = first[0] if first else how.parts
    most = most_exact(length, how)
    kept = scaled.filter((F.size("scaled") == length) & F.forall("scaled", lambda x: F.abs(x) <= most))
    padding = F.array_repeat(F.lit(0).cast("long"), -length % how.parts)
    return kept.select("vec_id", "label", F.concat(F.col("scaled").cast("array<long>"), padding).alias("vector"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _sums(books: np.ndarray):
    """Counts and sums of the parts of each entry, once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, entries, width = books.shape
        held, sums = np.zeros((parts, entries), np.int64), np.zeros(books.shape, np.int64)
        for batch in batches:
            vectors = _matrix(batch.column("vector"))
            for p in range(parts):
                own = vectors[:, p * width : (p + 1) * width]
                index, _ = nearest(own, books[p])
                held[p] += np.bincount(index, minlength=entries)
                np.add.at(sums[p], index, own)
        p, e = np.nonzero(held)
        if len(p):
            yield pa.RecordBatch.from_arrays(
                [pa.array(p), pa.array(e), pa.array(held[p, e]), pa.array(list(sums[p, e]), pa.list_(pa.int64()))],
                names=["part", "entry", "n", "sums"],
            )

    return run


def fit(vectors: DataFrame, how: Coding = Coding()) -> np.ndarray:
    """Codebooks (part, entry, position) after all rounds over all vectors."""
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(how.entries).select("vector").collect()
    start = np.array([r[0] for r in first], np.int64)
    books = np.stack(np.split(start, how.parts, axis=1))
    width = books.shape[2]
    for _ in range(how.rounds):
        found = vectors.select("vector").mapInArrow(_sums(books), "part long, entry long, n long, sums array<long>")
        sums = [F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(width)]
        for r in found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *sums).collect():  # a row for each entry
            books[r.part, r.entry] = [r[f"s{i}"] // r.n for i in range(width)]
    return books


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def _coded(books: np.ndarray):
    def make():
        width = books.shape[2]

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            vectors = _matrix(batch.column("vector"))
            found = [nearest(vectors[:, p * width : (p + 1) * width], book) for p, book in enumerate(books)]
            codes = np.stack([i for i, _ in found], axis=1).astype(np.uint8)
            return pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"), batch.column("label"), pa.array([c.tobytes().hex() for c in codes]),
                    pa.array(sum(d for _, d in found)),
                ],
                names=["vec_id", "label", "code", "error"],
            )

        return each

    return make


def encode(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id, label, code (two hexadecimal digits a part) and squared error of each vector."""
    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema}
    schema = f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long"
    return vectors.mapInArrow(per_batch(_coded(books)), schema)


def decode(codes: Column, books: np.ndarray, how: Coding = Coding()) -> Column:
    """The entries of a code, joined and scaled back: the vector as the code has it."""
    literal = F.array(*(F.array(*(F.array(*map(F.lit, e)) for e in book)) for book in books.tolist()))
    place = lambda p: F.conv(F.substring(codes, 2 * p + 1, 2), 16, 10).cast("int")
    found = F.flatten(F.array(*(F.get(F.get(literal, F.lit(p)), place(p)) for p in range(how.parts))))
    return F.transform(found, lambda x: x / how.scale)


def with_label_error(coded: DataFrame) -> DataFrame:
    """Coded rows with the error summed over equal labels, nulls together; a label may hold most rows."""
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    same = F.col("c.label").eqNullSafe(F.col("s.label"))
    if sums.limit(LABELS + 1).count() <= LABELS:
        return coded.alias("c").join(F.broadcast(sums.alias("s")), same).select("c.*", "s.label_error")
    salted = coded.withColumn("_salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)))
    copies = sums.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    joined = salted.alias("c").join(copies.alias("s"), same & (F.col("c._salt") == F.col("s._salt")))
    return joined.select("c.vec_id", "c.label", "c.code", "c.error", "s.label_error")


def compress(rows: DataFrame, how: Coding = Coding()) -> DataFrame:
    """vec_id, code, error, label_error and the digest of the codebooks fitted on all vectors."""
    short_batches(rows.sparkSession)
    vectors = stored(integers(rows, how), "integers")
    if vectors.isEmpty():
        books, coded = np.zeros((0, 0, 0), np.int64), vectors.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
    else:
        books = fit(vectors, how)
        coded = stored(encode(vectors, books), "codes")
    return with_label_error(coded).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )
