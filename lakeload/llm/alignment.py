"""Tokens of one vocabulary against tokens of another over the same bytes, and how often they meet.

A byte-level vocabulary (A) and a piece vocabulary (B) encode a space and the text. Byte offsets where a token of
each ends cut both into groups; two tokens whose bytes overlap are linked. Texts are cut at single spaces, where
both vocabularies end a token whatever follows, and segments again before line ends, stops and commas (checked for
the files given); each distinct part is encoded and aligned once and remembered, and so is what segments are joined to.

Linked pairs are counted over the corpus with minimal perfect hashing. The first pass gives the pairs and counts of
each task's portions. The distinct pairs are hashed in buckets, a record of a few bits and the key for each. Every
share of the counts of a bucket becomes a dense vector indexed by the hash, and vectors are summed in a tree. The
second pass aligns every text again and looks its links up. The commonest pairs, ``FRONT`` at most, are hashed once
more into a table that is broadcast; keys kept in it show what is not there, and those pairs, which are rare, are
joined with the counted pairs.

Null and empty texts, and texts whose tokens do not give back the space and the text, have no tokens and count
nothing. Repeated rows count as often as they come, a null id is an id. Long texts are cut like others. Columns
but ``doc_id`` and ``text`` are not read, whatever their names. An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeload.llm import hashing
from lakeload.llm.common import ROWS, short_batches, stored, uncollected
from lakeload.llm.segments import STOP, Generations, parts, portions, segments

#: Segments and parts remembered in each of two generations, characters in one, segments counted before they are
#: passed on.
REMEMBERED, PARTS, LONGEST, COUNTED = 250_000, 250_000, 48, 200_000
#: Most pairs that are broadcast. Rows of counts that one dense vector is made of on average; vectors summed at once.
FRONT, SHARE, FAN_IN = 1 << 22, 1 << 18, 16


class Aligned(NamedTuple):
    """A segment: numbers of tokens and groups, the keys of its links (32 bits each), its groups as text if asked for."""

    a: int
    b: int
    groups: int
    links: bytes
    text: str


def _byte_table() -> dict[int, int]:
    """Characters of byte-level vocabularies and their bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {ord(chr(b)): b for b in plain} | {256 + i: b for i, b in enumerate(others)}


def byte_level_pieces(vocabulary: str) -> dict[bytes, int]:
    """Bytes of the entries of a byte-level vocabulary file, without its added tokens."""
    told, letters = json.loads(vocabulary), _byte_table()
    added = {t["content"] for t in told["added_tokens"]}
    return {bytes(letters[ord(c)] for c in piece): i for piece, i in told["model"]["vocab"].items() if piece not in added}


class Aligner:
    """Both vocabularies in a worker. ``pattern`` splits texts for A; characters beyond Latin ones go to A's library."""

    def __init__(self, first: str, second: bytes, pattern: str, written: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        ranks = byte_level_pieces(first)
        self.fast = tiktoken.Encoding("first", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.whole = Tokenizer.from_str(first)
        self.whole.encode_special_tokens = True
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=second)
        self.bytes_a = [b""] * (max(ranks.values()) + 1)
        for piece, i in ranks.items():
            self.bytes_a[i] = piece
        self.bytes_b = [self._piece(i) for i in range(self.pieces.vocab_size())]
        self.length_a = np.array([len(p) for p in self.bytes_a], np.int64)
        self.length_b = np.array([len(p) for p in self.bytes_b], np.int64)
        self.width, self.written = len(self.bytes_b), written
        # The id of each token with what may follow it: the next of its side, or the end of the side.
        ids_a, ids_b = ([str(i) for i in range(len(x))] if written else [] for x in (self.bytes_a, self.bytes_b))
        self.names = [i + c for ids, ends in ((ids_a, ",|"), (ids_b, ",;")) for c in ends for i in ids]
        if len(self.bytes_a) * self.width >= 1 << 31:
            raise ValueError("the two vocabularies have too many pairs for keys of 31 bits")

    def _piece(self, i: int) -> bytes:
        piece = self.pieces.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(i) else piece.replace("▁", " ").encode()

    def align(self, found: list[str]) -> list[Aligned | None]:
        """Parts of segments, those at the head of one with the space before it; None where tokens do not give
        the bytes back."""
        latin = [p.isascii() or max(p) < "ɐ" for p in found]
        rest = iter(self.whole.encode_batch_fast([p for p, l in zip(found, latin) if not l], add_special_tokens=False))
        a = [self.fast(p) if l else next(rest).ids for p, l in zip(found, latin)]
        # The model puts a space before all it encodes. A line end is a token of its own: what follows it stands as
        # it would inside a text.
        spaced = [p[:1] == " " and len(p) > 1 for p in found]
        b = self.pieces.encode([p[1:] if s else "\n" + p for p, s in zip(found, spaced)], num_threads=1)
        b = [x if s else x[2:] for x, s in zip(b, spaced)]
        whole = [p.encode() for p in found]
        good = self._same(a, self.bytes_a, whole) and self._same(b, self.bytes_b, whole)
        if not good:
            good = [self._same([x], self.bytes_a, [w]) and self._same([y], self.bytes_b, [w]) for x, y, w in zip(a, b, whole)]
            a, b = ([x for x, g in zip(ids, good) if g] for ids in (a, b))
            made = iter(self._aligned(a, b) if a else [])
            return [next(made) if g else None for g in good]
        return self._aligned(a, b)

    @staticmethod
    def _same(ids: list[list[int]], pieces: list[bytes], whole: list[bytes]) -> bool:
        """Whether the tokens of each part have its bytes."""
        flat = [pieces[i] for i in chain.from_iterable(ids)]
        if b"".join(flat) != b"".join(whole):
            return False
        ends = np.cumsum([0, *map(len, flat)])[np.cumsum([len(x) for x in ids])]
        return bool((ends == np.cumsum([len(w) for w in whole])).all())

    def _aligned(self, a: list[list[int]], b: list[list[int]]) -> list[Aligned]:
        """All segments beside each other: every offset where a token ends closes a link, a shared one a group."""
        count_a, count_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b))
        ids_a, ids_b = (np.array(list(chain.from_iterable(x)), np.int64) for x in (a, b))
        ends_a, ends_b = np.cumsum(self.length_a[ids_a]), np.cumsum(self.length_b[ids_b])
        ends = np.union1d(ends_a, ends_b)
        at_a, at_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        links = ids_a[at_a] * self.width + ids_b[at_b]
        shared = (ends_a[at_a] == ends) & (ends_b[at_b] == ends)
        last_a, last_b = np.cumsum(count_a), np.cumsum(count_b)
        last = np.searchsorted(ends, ends_a[last_a - 1]) + 1
        first = np.r_[0, last[:-1]]
        closed = np.cumsum(shared)
        groups = np.diff(np.r_[0, closed[last - 1]])
        texts = self._texts(ids_a, ids_b, at_a[shared] + 1, at_b[shared] + 1, groups) if self.written else [""] * len(a)
        data, new = links.astype("<u4").tobytes(), tuple.__new__
        of_each = [data[s:e] for s, e in zip((4 * first).tolist(), (4 * last).tolist())]
        return [new(Aligned, x) for x in zip(count_a.tolist(), count_b.tolist(), groups.tolist(), of_each, texts)]

    def _texts(self, a: np.ndarray, b: np.ndarray, until_a: np.ndarray, until_b: np.ndarray, groups: np.ndarray) -> list[str]:
        """Groups of each part as text: the names of A's tokens, then of B's, each with the sign that follows it."""
        n_a, n_b, width = len(a), len(b), len(self.bytes_a)
        last_a, last_b = np.zeros(n_a, bool), np.zeros(n_b, bool)
        last_a[until_a - 1], last_b[until_b - 1] = True, True
        # Before a token of A stand A's before it and B's of earlier groups; before one of B, A's of its group too.
        of_a, of_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        at_a = np.arange(n_a) + np.r_[0, until_b][of_a]
        at_b = np.arange(n_b) + until_a[of_b]
        code = np.empty(n_a + n_b, np.int64)
        code[at_a] = a + width * last_a
        code[at_b] = 2 * width + b + self.width * last_b
        names = list(map(self.names.__getitem__, code.tolist()))
        ends = np.r_[0, until_a + until_b][np.cumsum(groups)].tolist()
        return ["".join(names[s:e])[:-1] for s, e in zip([0, *ends], ends)]


class _BySegment:
    """What is made of segments by joining what is made of their parts; both are remembered."""

    def __init__(self, make: Callable[[list[str]], list], join: Callable[[list], object]):
        self.parts, self.join = Generations(make, PARTS, LONGEST), join
        self.segments = Generations(self._joined, REMEMBERED, LONGEST)
        self.all = self.segments.all

    def _joined(self, found: list[str]) -> list:
        cut = [[" " + s] if s.isalnum() else parts(" " + s) for s in found]
        made = self.parts.all(set().union(*cut))
        return [made[c[0]] if len(c) == 1 else self.join([made[p] for p in c]) for c in cut]


class Alignment:
    """Two vocabularies given by their files, ready to align a corpus."""

    def __init__(self, spark: SparkSession, first: str, second: str, pattern: str):
        """``first``: a byte-level vocabulary with its merges, ``second``: a piece model; paths on the driver."""
        short_batches(spark)
        with open(first, encoding="utf-8") as a, open(second, "rb") as b:
            self.files = a.read(), b.read(), pattern
        told = json.loads(self.files[0])
        merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in told["model"]["merges"]]
        order = [told["model"]["vocab"][m] for m in merged]
        aligner = Aligner(*self.files, False)
        inside = [
            p for p in aligner.bytes_b
            if b" " in p[1:] and p.strip(b" ") or b"\n" in p and len(p) > 1 or STOP.search(p.decode(errors="replace"))
        ]
        if order != sorted(order) or inside:
            raise ValueError("the files need merges in the order of their ids and no piece over a place where texts are cut")
        self.spark, self.width = spark, aligner.width
        self.shared = spark.sparkContext.broadcast((self.files, {}))

    def pairs(self, docs: DataFrame) -> DataFrame:
        """First pass: pairs with their counts in portions of the corpus, ``portion`` numbering these at random."""
        shared = self.shared

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, counted, held, lost = _links(shared), Counter(), {}, set()

            def out() -> pa.RecordBatch:
                links = [held[s] for s in counted]
                times = np.repeat(np.fromiter(counted.values(), np.int64, len(counted)), [len(x) // 4 for x in links])
                keys, at = np.unique(np.frombuffer(b"".join(links), "<u4"), return_inverse=True)
                counted.clear()
                held.clear()
                lost.clear()
                n = np.bincount(at, weights=times).astype(np.int64)
                portion = np.full(len(keys), int.from_bytes(os.urandom(3), "big"), np.int64)
                return pa.RecordBatch.from_arrays(
                    [pa.array(keys.astype(np.int64)), pa.array(n), pa.array(portion)], names=["pair", "n", "portion"]
                )

            for batch in batches:
                for texts in portions([t for t in batch.column("text").to_pylist() if t]):
                    with uncollected():
                        every = [segments(t) for t in texts]
                        each = set().union(*every)
                        found, new = known.all(each), each.difference(held)
                        held.update(zip(new, map(found.__getitem__, new)))
                        lost.update(s for s in new if not held[s])
                        if not lost.isdisjoint(each):
                            every = [e for e in every if lost.isdisjoint(e)]
                        counted.update(chain.from_iterable(every))
                    if len(counted) > COUNTED:
                        yield out()
            if counted:
                yield out()

        return docs.select("text").mapInArrow(run, "pair long, n long, portion long")

    def score(self, docs: DataFrame, counts: PairCounts, groups: bool = False) -> DataFrame:
        """Second pass: each text's tokens, groups and links against the corpus; ``groups`` adds the groups' text."""
        shared, front, width = self.shared, counts.front, self.width
        names = ["doc_id", *(c for c in SCORES), "groups_sha256", *(["groups"] if groups else []), "rest"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            scored = _scores(shared, front, width)
            for batch in batches:
                ids, texts = batch.column("doc_id"), batch.column("text").to_pylist()
                for s in range(0, len(texts), ROWS):
                    rows = []
                    for some in portions([t or "" for t in texts[s : s + ROWS]]):
                        with uncollected():
                            every = [segments(t) if t else [] for t in some]
                            found = scored.all(set().union(*every))
                            rows += [_row(list(map(found.__getitem__, e)), groups) for e in every]
                    arrays = [pa.array(c, k) for c, k in zip(zip(*rows), _KINDS if groups else _KINDS[:7] + _KINDS[8:])]
                    yield pa.RecordBatch.from_arrays([ids.slice(s, ROWS), *arrays], names=names)

        schema = "doc_id long, " + ", ".join(f"{c} long" for c in SCORES) + ", groups_sha256 string"
        schema += (", groups string" if groups else "") + ", rest array<struct<pair: long, n: long>>"
        found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
        found = stored(found.withColumn("_row", F.monotonically_increasing_id()), "aligned")
        return counts.completed(found).drop("_row", "rest")


SCORES = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
_REST = pa.list_(pa.struct([("pair", pa.int64()), ("n", pa.int64())]))
_KINDS = [*[pa.int64()] * 6, pa.string(), pa.string(), _REST]


def _links(shared: Broadcast) -> _BySegment:
    """Links of segments; a worker keeps them from task to task."""
    files, kept = shared.value
    if "links" not in kept:
        align = Aligner(*files, False).align
        links = lambda found: [a and a.links for a in align(found)]
        kept["links"] = _BySegment(links, lambda made: None if None in made else b"".join(made))
    return kept["links"]


def _scores(shared: Broadcast, front: Broadcast, width: int) -> _BySegment:
    """Scores of segments; a worker keeps them, and no longer what the first pass kept."""
    (files, kept), (table, n, best, scores) = shared.value, front.value
    if "scores" not in scores:
        kept.clear()
        aligner = Aligner(*files, True)
        scores["scores"] = _BySegment(lambda found: _scored(aligner.align(found), table, n, best, width), _together)
    return scores["scores"]


def _scored(aligned: list[Aligned | None], table: hashing.Table, n: np.ndarray, best: np.ndarray, width: int) -> list:
    """Of each part: its numbers as bytes, its groups as text, and its links that the front does not hold."""
    kept = [a.links for a in aligned if a]
    if not kept:
        return [None] * len(aligned)
    links = np.frombuffer(b"".join(kept), "<u4").astype(np.int64)
    place = table.find(links)
    there = place >= 0
    count = np.where(there, n[place], 0) if len(n) else np.zeros(len(links), np.int64)
    top = there & (count == best[links % width])
    ends = np.cumsum([len(x) // 4 for x in kept])
    starts = ends - [len(x) // 4 for x in kept]
    numbers = np.empty((len(kept), len(SCORES)), np.int64)
    numbers[:, :3] = [x[:3] for x in aligned if x]
    numbers[:, 3] = ends - starts
    numbers[:, 4], numbers[:, 5], lost = (np.add.reduceat(x.astype(np.int64), starts) for x in (top, count, ~there))
    data, width, out, i = numbers.tobytes(), 8 * len(SCORES), [], 0
    for x in aligned:
        if x is None:
            out.append(None)
            continue
        rest = links[starts[i] : ends[i]][~there[starts[i] : ends[i]]].tolist() if lost[i] else None
        out.append((data[width * i : width * (i + 1)], x.text, rest))
        i += 1
    return out


def _sums(data: Iterable[bytes]) -> np.ndarray:
    """The numbers of all parts, added up."""
    return np.frombuffer(b"".join(data), np.int64).reshape(-1, len(SCORES)).sum(0)


def _together(made: list) -> tuple | None:
    """The scores of a segment: those of its parts beside each other."""
    if None in made:
        return None
    numbers, texts, rests = zip(*made)
    return b"".join(numbers), ";".join(texts), [p for r in rests if r for p in r] or None


def _row(found: list, groups: bool) -> tuple:
    if not found or None in found:
        return (0,) * 6 + (("", "", []) if groups else ("", []))
    numbers, texts, rests = zip(*found)
    text = ";".join(texts)
    told = [{"pair": p, "n": n} for p, n in Counter(p for r in rests if r for p in r).items()] if any(rests) else []
    digest = hashlib.sha256(text.encode()).hexdigest()
    return (*_sums(numbers).tolist(), *((digest, text, told) if groups else (digest, told)))


class PairCounts:
    """How often pairs are linked: buckets of hashed keys with dense counts, and the commonest of them broadcast."""

    def __init__(self, pairs: DataFrame, width: int, front: int = FRONT):
        spark, self.width = pairs.sparkSession, width
        portions_of = stored(pairs, "pairs")
        keys = stored(portions_of.select("pair").distinct(), "distinct-pairs")
        self.buckets = hashing.buckets_for(keys.count())
        hashed = stored(_hashed(keys, self.buckets), "hashed-pairs")
        dense = self._summed(portions_of, hashed)
        counted = hashed.select("bucket", "keys").join(dense, "bucket")
        #: Every pair with its count.
        self.counted = stored(counted.mapInArrow(_exploded, "pair long, n long"), "counted-pairs")
        best = self.counted.groupBy((F.col("pair") % width).alias("b")).agg(F.max("n").alias("best"))
        self.best = stored(best, "best-pairs")
        self.front = spark.sparkContext.broadcast(self._front(front))

    def _summed(self, pairs: DataFrame, hashed: DataFrame) -> DataFrame:
        """Dense counts of each bucket: vectors of shares of its rows, summed in a tree."""
        shares = max(1, -(-pairs.count() // (self.buckets * SHARE)))
        rows = pairs.select(
            _bucket(self.buckets), F.pmod(F.xxhash64("portion"), F.lit(shares)).cast("int").alias("share"), "pair", "n"
        )
        copies = hashed.withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1)))).drop("n_keys")

        def vector(key: tuple, rows: pa.Table, records: pa.Table) -> pa.Table:
            record = records.to_pylist()[0]
            table = _table([record])
            place = table.find(rows.column("pair").to_numpy())
            if (place < 0).any():
                raise ValueError("a pair is missing from its bucket")
            sums = np.zeros(len(table.keys), np.int64)
            np.add.at(sums, place, rows.column("n").to_numpy())
            return _vectors(record["bucket"], key[1].as_py(), sums)

        schema = "bucket long, share int, counts binary"
        dense = rows.groupBy("bucket", "share").cogroup(copies.groupBy("bucket", "share")).applyInArrow(
            lambda key, left, right: vector(key, left, right) if left.num_rows else _vectors(None, None, None), schema
        )

        def total(key: tuple, table: pa.Table) -> pa.Table:
            sums = sum(np.frombuffer(c, np.int64) for c in table.column("counts").to_pylist())
            return _vectors(key[0].as_py(), key[1].as_py(), sums)

        while True:
            shares = -(-shares // FAN_IN)
            dense = dense.withColumn("share", F.floor(F.col("share") / FAN_IN).cast("int"))
            dense = dense.groupBy("bucket", "share").applyInArrow(total, schema)
            if shares == 1:
                return dense.drop("share")

    def _front(self, most: int) -> tuple[hashing.Table, np.ndarray, np.ndarray, dict]:
        """The commonest pairs, all above the count at which they still fit, hashed with their counts."""
        step = F.floor(F.log2(F.col("n").cast("double")) * 8)
        steps = self.counted.groupBy(step.alias("step")).count().collect()  # some hundred
        least, held = None, 0
        for r in sorted(steps, key=lambda r: -r["step"]):
            if held + r["count"] > most:
                break
            least, held = r["step"], held + r["count"]
        best = np.zeros(self.width, np.int64)
        for r in self.best.collect():  # one for each id of B at most
            best[r.b] = r.best
        if least is None:
            return hashing.Table([], np.zeros(0, np.int64)), np.zeros(0, np.int64), best, {}
        records = _hashed(self.counted.filter(step >= least), hashing.buckets_for(held)).orderBy("bucket").toArrow()
        n = np.concatenate([np.frombuffer(c, np.int64) for c in records.column("counts").to_pylist()])
        whole = {r["bucket"]: r for r in records.to_pylist()}
        empty = {"sizes": [], "bits": b"", "keys": b""}
        return _table([whole.get(i, empty) for i in range(hashing.buckets_for(held))]), n, best, {}

    def completed(self, found: DataFrame) -> DataFrame:
        """Rows with the counts of the links that the front did not hold."""
        rest = found.select("_row", F.explode("rest").alias("r")).select("_row", "r.pair", F.col("r.n").alias("times"))
        joined = rest.join(self.counted, "pair").withColumn("b", F.col("pair") % self.width)
        joined = joined.join(F.broadcast(self.best), "b")
        sums = joined.groupBy("_row").agg(
            F.sum(F.col("times") * F.col("n")).alias("_sum"),
            F.sum(F.when(F.col("n") == F.col("best"), F.col("times")).otherwise(0)).alias("_top"),
        )
        more = lambda c, d: (F.col(c) + F.coalesce(F.col(d), F.lit(0))).cast("long")
        whole = found.join(sums, "_row", "left")
        return whole.withColumns({"count_sum": more("count_sum", "_sum"), "n_best": more("n_best", "_top")}).drop("_sum", "_top")


def _bucket(buckets: int):
    return F.shiftright(F.col("pair") * hashing.FACTOR, hashing.SHIFT).bitwiseAND(F.lit(buckets - 1).cast("long")).alias("bucket")


def _vectors(bucket, share, sums) -> pa.Table:
    rows = [] if sums is None else [(bucket, share, sums.tobytes())]
    columns = list(zip(*rows)) or [[], [], []]
    kinds = [("bucket", pa.int64()), ("share", pa.int32()), ("counts", pa.binary())]
    return pa.table([pa.array(c, k) for c, (_, k) in zip(columns, kinds)], names=[n for n, _ in kinds])


def _table(records: list[dict]) -> hashing.Table:
    """Records of buckets, in their order, as a table; a single one may be any bucket."""
    buckets = []
    for r in records:
        words = np.frombuffer(r["bits"], "<u8")
        ends = np.cumsum(r["sizes"]).astype(int).tolist()
        buckets.append((list(r["sizes"]), [words[s:e] for s, e in zip([0, *ends], ends)]))
    return hashing.Table(buckets, np.concatenate([np.frombuffer(r["keys"], np.int64) for r in records]))


def _hashed(pairs: DataFrame, buckets: int) -> DataFrame:
    """A record for each bucket: its levels, bitmaps, and keys in order, with their counts if the pairs have any."""
    counted = "n" in pairs.columns

    def record(table: pa.Table) -> pa.Table:
        keys = table.column("pair").to_numpy()
        sizes, bits, ordered = hashing.build(keys)
        columns = [
            pa.array(table.column("bucket").to_pylist()[:1], pa.int64()), pa.array([len(ordered)], pa.int64()),
            pa.array([sizes.tolist()], pa.list_(pa.int32())), pa.array([bits.tobytes()], pa.binary()),
            pa.array([ordered.tobytes()], pa.binary()),
        ]
        names = ["bucket", "n_keys", "sizes", "bits", "keys"]
        if counted:
            by = np.argsort(keys)
            n = table.column("n").to_numpy()[by][np.searchsorted(keys[by], ordered)]
            columns.append(pa.array([n.tobytes()], pa.binary()))
            names.append("counts")
        return pa.table(columns, names=names)

    schema = "bucket long, n_keys long, sizes array<int>, bits binary, keys binary" + (", counts binary" if counted else "")
    chosen = ["pair", "n"] if counted else ["pair"]
    return pairs.select(_bucket(buckets), *chosen).groupBy("bucket").applyInArrow(record, schema)


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for keys, counts in zip(batch.column("keys").to_pylist(), batch.column("counts").to_pylist()):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.frombuffer(keys, np.int64)), pa.array(np.frombuffer(counts, np.int64))], names=["pair", "n"]
            )


def align(docs: DataFrame, first: str, second: str, pattern: str, groups: bool = False) -> DataFrame:
    """Both passes over the documents."""
    ready = Alignment(docs.sparkSession, first, second, pattern)
    return ready.score(docs, PairCounts(ready.pairs(docs), ready.width), groups)
