"""Byte-level BPE: ranked merges folded by Spark's higher-order functions over distinct words.

A *word* here is one match of the split pattern. All words of the corpus are counted; those frequent enough to
fit ``FREQUENT`` entries are folded by Spark, once each: a word becomes an array of one-byte pieces, and an
aggregate over it joins the lowest-ranked neighbours, leftmost first, until no neighbours have a rank. Ranks
come from a literal: an array of small maps, because Spark searches one large map from its beginning each time.
The result, at most ``FREQUENT`` short words with their ids, is broadcast and applied to whole texts; a word
that is not in it is folded where it stands by the same rule and remembered by its task. The bound changes where
a word is folded, never its ids.

Decoding concatenates the bytes of the pieces. Null texts are empty; an empty text has no ids. Texts are encoded
one by one, so repeated rows and ids need no care. Special tokens in a text are ordinary text.
"""

from __future__ import annotations

import base64
import heapq
import json
import zlib
from array import array
from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.llm.common import Remembered, per_batch, short_batches, stored

#: Most words that are broadcast, most bytes in one, stretches that a task remembers besides, and words of mixed
#: ones, in each of two generations; words and stretches it counts before it passes them on.
FREQUENT, LONGEST, REMEMBERED, WORDS, COUNTED = 1 << 18, 48, 60_000, 20_000, 300_000
#: Maps in the literal of ranks; a rank is sought in one of them.
MAPS = 1 << 15
#: Stands for no rank.
NONE = 1 << 30
#: White space but the space; in ASCII text only the first part of it can be.
_WHITE = [chr(i) for i in range(0x3001) if chr(i).isspace() and chr(i) != " "]
_ASCII_WHITE = [c for c in _WHITE if c.isascii()]


def load_ranks(path: str) -> dict[bytes, int]:
    """Pieces and their ranks, which are also their ids, from a rank file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def splitter(pattern: str) -> regex.Pattern:
    """The pattern with white space as Unicode has it, which excludes some control characters."""
    inside, outside = pattern.replace(r"[^\s", r"[^\p{White_Space}"), r"\P{White_Space}"
    return regex.compile(inside.replace(r"\s", r"\p{White_Space}").replace(r"\S", outside))


def uneven(text: str) -> bool:
    """Whether a space is beside other white space. Where none is, no match of the pattern reaches over a space from
    the left, so the stretches between spaces can be split one by one, each with the space before it."""
    if "  " in text:
        return True
    for c in _ASCII_WHITE if text.isascii() else _WHITE:
        if c in text and (" " + c in text or c + " " in text):
            return True
    return False


def words_after_space(stretch: str, find: Callable[[str], list[str]]) -> list[str]:
    """The words of a stretch without spaces and of the space before it.

    Letters alone are one word, and a comma or full stop after them another; the pattern is only needed for
    the rest.
    """
    if stretch.isalpha():
        return [" " + stretch]
    if stretch[-1:] in (",", ".") and stretch[:-1].isalpha():
        return [" " + stretch[:-1], stretch[-1]]
    return find(" " + stretch)


def byte_pairs(ranks: dict[bytes, int]) -> list[int]:
    """The rank of each two bytes, at 256 times the first plus the second."""
    return [ranks.get(bytes(divmod(i, 256)), NONE) for i in range(1 << 16)]


def fold(word: bytes, ranks: dict[bytes, int], pairs: list[int] | None = None) -> list[int]:
    """Ids of one word: its lowest-ranked neighbours are joined, leftmost first, until none has a rank.

    ``pairs``, if given, are the ``byte_pairs`` of the ranks.
    """
    if word in ranks:
        return [ranks[word]]
    if len(word) > 400:
        return _fold_long(word, ranks)
    get, cuts = ranks.get, list(range(len(word) + 1))
    if pairs:
        joins = [pairs[a << 8 | b] for a, b in zip(word, word[1:])]
    else:
        joins = [get(word[i : i + 2], NONE) for i in range(len(word) - 1)]
    joins.append(NONE)  # the last piece has nothing after it
    while (least := min(joins)) < NONE:
        i = joins.index(least)
        del joins[i], cuts[i + 1]
        if i + 2 < len(cuts):
            joins[i] = get(word[cuts[i] : cuts[i + 2]], NONE)
        if i:
            joins[i - 1] = get(word[cuts[i - 1] : cuts[i + 1]], NONE)
    return [ranks[word[a:b]] for a, b in zip(cuts, cuts[1:])]


def _fold_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap, for words of any length."""
    end = list(range(1, len(word) + 1))  # where the piece that starts here ends; 0 for no piece
    before = list(range(-1, len(word) - 1))  # where the piece before it starts
    heap: list[tuple[int, int, int, int]] = []

    def offer(a: int) -> None:
        middle = end[a]
        if a >= 0 and middle < len(word) and (rank := ranks.get(word[a : end[middle]])) is not None:
            heapq.heappush(heap, (rank, a, middle, end[middle]))

    for a in range(len(word) - 1):
        offer(a)
    while heap:
        _, a, middle, b = heapq.heappop(heap)
        if end[a] != middle or end[middle] != b:
            continue  # one of the two has been joined since
        end[a], end[middle] = b, 0
        if b < len(word):
            before[b] = a
        offer(a)
        if before[a] >= 0:
            offer(before[a])
    out, a = [], 0
    while a < len(word):
        out.append(ranks[word[a : end[a]]])
        a = end[a]
    return out


def _rank_maps(ranks: dict[bytes, int]) -> Column:
    """The literal: each byte is the character of its number, and a piece lies in the map its checksum names."""
    maps: list[dict[str, int]] = [{} for _ in range(MAPS)]
    for piece, rank in ranks.items():
        name = piece.decode("latin-1")
        maps[zlib.crc32(name.encode()) % MAPS][name] = rank
    return F.from_json(F.lit(json.dumps(maps)), "array<map<string, int>>")


def folded(word: Column, ranks: dict[bytes, int]) -> Column:
    """Ids of a word (string column) by higher-order functions alone."""

    def fold_with(maps: Column) -> Column:
        def rank(piece: Column) -> Column:
            place = (F.crc32(piece.cast("binary")) % MAPS).cast("int")
            return F.try_element_at(F.get(maps, place), piece)

        def join(now: Column, _: Column) -> Column:
            pairs = F.transform(
                F.sequence(F.lit(0), F.size(now) - 2),
                lambda i: F.coalesce(rank(F.concat(F.get(now, i), F.get(now, i + 1))), F.lit(NONE)),
            )

            def joined(found: Column) -> Column:
                at = F.array_position(found, F.array_min(found)).cast("int")
                both = F.array(F.concat(F.get(now, at - 1), F.get(now, at)))
                parts = F.concat(F.slice(now, F.lit(1), at - 1), both, F.slice(now, at + 2, F.size(now)))
                return F.when(F.array_min(found) == NONE, now).otherwise(parts)

            return F.when(F.size(now) < 2, now).otherwise(_let(pairs, joined))

        steps = F.sequence(F.lit(1), F.greatest(F.length(letters) - 1, F.lit(1)))
        whole = rank(letters)
        return F.when(whole.isNotNull(), F.array(whole)).otherwise(F.transform(F.aggregate(steps, pieces, join), rank))

    letters = F.decode(word.cast("binary"), "ISO-8859-1")
    pieces = F.transform(F.sequence(F.lit(1), F.length(letters)), lambda i: F.substr(letters, i, F.lit(1)))
    return _let(_rank_maps(ranks), fold_with)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed, or written into the plan, once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _counted(pattern: str):
    """Words of whole texts with their counts; long ones are left to be folded where they stand."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, words, stretches = splitter(pattern).findall, Counter(), Counter()

        def out() -> pa.RecordBatch:
            while stretches:  # each goes as its words come, so that both are not held at once
                stretch, n = stretches.popitem()
                for w in words_after_space(stretch, find):
                    words[w] += n
            short = [w for w in words if len(w) <= LONGEST and len(w.encode()) <= LONGEST]
            columns = [pa.array(short, pa.string()), pa.array(map(words.__getitem__, short), pa.int64(), size=len(short))]
            stretches.clear()
            words.clear()
            return pa.RecordBatch.from_arrays(columns, names=["word", "n"])

        for batch in batches:
            for text in batch.column("text").to_pylist():
                if not text:
                    continue
                if uneven(text):
                    words.update(find(text))
                else:
                    first, *rest = text.split(" ")
                    words.update(find(first))
                    stretches.update(rest)
                if len(words) + len(stretches) > COUNTED:
                    yield out()
        yield out()

    return run


def at_most(counted: DataFrame, words: int) -> DataFrame:
    """Words with the highest counts, no more than asked for: all above the count at which they still fit."""
    steps = counted.groupBy(F.floor(F.log2(F.col("n").cast("double")) * 8).alias("step")).count()
    least, held = None, 0
    for r in sorted(steps.collect(), key=lambda r: -r["step"]):  # a few hundred steps at most
        if held + r["count"] > words:
            break
        least, held = r["step"], held + r["count"]
    if least is None:
        return counted.limit(0)
    return counted.filter(F.floor(F.log2(F.col("n").cast("double")) * 8) >= least)


def _kind(ranks: dict[bytes, int]) -> type:
    return np.uint16 if max(ranks.values()) < 1 << 16 else np.uint32


class Frequent(NamedTuple):
    """Words and their ids one after the other, as buffers: workers make objects of them, the driver does not."""

    words: pa.Array
    ids: bytes
    ends: np.ndarray  # of each word's ids, in bytes

    @classmethod
    def of(cls, table: pa.Table, kind: type) -> Frequent:
        words, ids = (table.column(c).combine_chunks() for c in ("word", "ids"))
        ends = np.cumsum(ids.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64) * np.dtype(kind).itemsize
        return cls(words, ids.flatten().to_numpy(zero_copy_only=False).astype(kind).tobytes(), ends)

    def by_word(self) -> dict[str, bytes]:
        ends = self.ends.tolist()
        return {w: self.ids[s:e] for w, s, e in zip(self.words.to_pylist(), [0, *ends], ends)}


class Encoder:
    """Ids of texts; knows the frequent words and remembers other stretches, each with its space, up to a bound."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, frequent: dict[str, bytes] | None = None):
        self.ranks, self.find, self.frequent = ranks, splitter(pattern).findall, frequent or {}
        self.kind = _kind(ranks)
        self.pieces: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for piece, rank in ranks.items():
            self.pieces[rank] = piece
        self.names = [str(i) for i in range(len(self.pieces))]
        code = "H" if self.kind is np.uint16 else "I"
        pairs = byte_pairs(ranks)
        self.fold = lambda w: array(code, fold(w.encode(), ranks, pairs)).tobytes()
        self.words = Remembered(self.fold, WORDS, LONGEST)
        self.stretches = Remembered(self._stretch, REMEMBERED, LONGEST)
        self.ends = {c: self.fold(c) for c in ",."}

    def _other(self, stretch: str) -> bytes:
        """A stretch that is no frequent word; of letters and a comma or full stop only the letters are remembered."""
        end = self.ends.get(stretch[-1])
        if end is None or not stretch[1:-1].isalpha():
            return self.stretches[stretch]
        word = stretch[:-1]
        return (self.frequent.get(word) or self.stretches[word]) + end

    def _stretch(self, stretch: str) -> bytes:
        words = words_after_space(stretch[1:], self.find)
        # One word is remembered as a stretch, not once more as a word.
        return self.fold(words[0]) if len(words) == 1 else self._all(words)

    def _all(self, words: list[str]) -> bytes:
        return b"".join([self.frequent.get(w) or self.words[w] for w in words])

    def encode(self, text: str | None) -> np.ndarray:
        if not text or "\0" in text or uneven(text):
            return np.frombuffer(self._all(self.find(text or "")), self.kind)
        first, *rest = text.replace(" ", "\0 ").split("\0")
        known, other = map(self.frequent.get, rest), self._other
        return np.frombuffer(self._all(self.find(first)) + b"".join([k or other(s) for k, s in zip(known, rest)]), self.kind)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.pieces.__getitem__, ids))

    def written(self, ids: list[int]) -> str:
        """Decimal ids, one space between."""
        return " ".join(map(self.names.__getitem__, ids))


class Bpe:
    """A vocabulary with the frequent words of a corpus, ready to encode it."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        short_batches(spark)
        self.spark, self.ranks, self.pattern = spark, load_ranks(path), pattern
        self.shared = None

    def prepare(self, docs: DataFrame) -> Bpe:
        """Fold the frequent words of ``docs`` and broadcast them."""
        words = docs.select("text").mapInArrow(_counted(self.pattern), "word string, n long")
        counted = stored(words.groupBy("word").agg(F.sum("n").alias("n")), "bpe-words")
        tasks = self.spark.sparkContext.defaultParallelism * 4
        # Stored, so that the plan with the literal has no exchange: the driver would get that plan anew after each.
        frequent = stored(at_most(counted, FREQUENT).select("word").repartition(tasks, "word"), "bpe-frequent")
        table = frequent.select("word", folded(F.col("word"), self.ranks).alias("ids")).toArrow()
        self.shared = self._broadcast(Frequent.of(table, _kind(self.ranks)))
        return self

    def _broadcast(self, frequent: Frequent | None) -> Broadcast:
        """What an encoder needs, and a place for the encoder itself, which a worker keeps from task to task."""
        return self.spark.sparkContext.broadcast((self.ranks, frequent, {}))

    def apply(self, docs: DataFrame, columns: dict[str, tuple[str, pa.DataType]], each, passed: list[str]) -> DataFrame:
        """``passed`` columns of ``docs`` and what ``each(encoder, text)`` gives for every row, by name and type."""
        shared, pattern = self.shared or self._broadcast(None), self.pattern

        def make():
            ranks, frequent, kept = shared.value
            if "encoder" not in kept:
                kept["encoder"] = Encoder(ranks, pattern, frequent and frequent.by_word())
            encoder = kept["encoder"]

            def run(batch: pa.RecordBatch) -> pa.RecordBatch:
                found = list(zip(*(each(encoder, t) for t in batch.column("text").to_pylist()))) or [[]] * len(columns)
                arrays = [pa.array(f, kind) for f, (_, kind) in zip(found, columns.values())]
                return pa.RecordBatch.from_arrays([*(batch.column(c) for c in passed), *arrays], names=[*passed, *columns])

            return run

        kinds = {f.name: f.dataType.simpleString() for f in docs.schema}
        schema = ", ".join([f"`{c}` {kinds[c]}" for c in passed] + [f"{c} {sql}" for c, (sql, _) in columns.items()])
        return docs.select(*dict.fromkeys([*passed, "text"])).mapInArrow(per_batch(make), schema)

    def encode(self, docs: DataFrame, passed: list[str]) -> DataFrame:
        """``passed`` and ids, an array of ints, for each row."""
        return self.apply(docs, {"ids": ("array<int>", pa.list_(pa.int32()))}, _ids, passed)

    def decode(self, ids: DataFrame, passed: list[str]) -> DataFrame:
        """``passed`` and the bytes of each row's ids, by the literal of pieces."""
        names = [""] * (max(self.ranks.values()) + 1)
        for piece, rank in self.ranks.items():
            names[rank] = base64.b64encode(piece).decode()
        pieces = F.from_json(F.lit(json.dumps(names)), "array<string>")
        # A binary value may be looked at as a string and back without change; joining strings takes linear time.
        bytes_of = F.transform("ids", lambda i: F.unbase64(F.get(pieces, i)).cast("string"))
        return ids.select(*passed, F.array_join(bytes_of, "").cast("binary").alias("bytes"))


def _ids(encoder: Encoder, text: str | None) -> tuple[np.ndarray]:
    return (encoder.encode(text).astype(np.int32),)
