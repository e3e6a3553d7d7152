import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lakeload.llm.packing import Packing, WordCoder, cuts, difference, pack, pieces, windows_of
from lakeload.llm.queries import QUERIES
from llm.helpers import awkward, empty

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)
CODER = WordCoder(open(PATH, encoding="utf-8").read())


def ids_of(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 2]


LETTERS = st.one_of(st.sampled_from(" \n\t\x0b\x1c\x85 　'sSTé½İßΣς.,aAÅ1日😀́̀ǅ<|>"), st.characters(exclude_categories=["Cs"]))


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=LETTERS))
def test_as_library(text):
    assert CODER.encode(text).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_special_and_long_texts():
    for text in ["a <|endoftext|> b<|startoftext|>c <|EndOfText|>", "Ab" * 5000, " " * 3000, "É́" * 300, "don't DON'T 12,345"]:
        assert CODER.encode(text).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_cuts():
    how = Packing(capacity=100, piece=30)
    for n in range(1, 400):
        starts = cuts(n, how)
        lengths = np.diff([*starts, n])
        assert starts[0] == 0 and (lengths > 0).all()
        assert (lengths[: n // 100] == 100).all() and (lengths[n // 100 :] <= 30).all()


@pytest.mark.parametrize("seed", range(30))
def test_differencing_keeps_every_piece(seed):
    rng = random.Random(seed)
    lengths = [rng.choice([1, 7, rng.randrange(1, 513)]) for _ in range(rng.randrange(1, 120))]
    count = rng.randrange(1, 25)
    window, sums = difference(lengths, count)
    assert 0 <= window.min() and window.max() < count
    assert sorted(np.bincount(window, weights=lengths, minlength=count)) == sorted(sums)
    # Differencing of many pieces leaves windows no further apart than the largest piece.
    assert sums.max() - sums.min() <= max(lengths)


def test_two_windows_as_by_hand():
    # 8 and 7 leave 1, 6 and 5 leave 1, 4 meets 1: 3, then 1: 2.
    assert sorted(difference([8, 7, 6, 5, 4], 2)[1]) == [14, 16]


def test_windows_rise_when_capacity_is_exceeded():
    window = windows_of([60, 60, 60, 60, 60], 100)
    assert sorted(np.bincount(window)) == [1, 1, 1, 1, 1]
    assert len(set(windows_of([50] * 10, 100))) == 5


def check(rows, texts, how):
    """Every id once, sequences gapless and within the capacity; returns padding and what is held."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for doc, own in by_doc.items():
        ids, at = np.array(ids_of(texts[doc]), "<u4"), 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= how.capacity
    held = sum(r.length for r in rows)
    return len(by_sequence) * how.capacity - held, held


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op11_packing"](spark, sf).collect()
    assert {r.doc_id for r in rows} == set(texts)
    padding, held = check(rows, texts, Packing())
    assert padding < 0.01 * held


def test_small_capacity_with_ids(spark):
    docs = spark.createDataFrame([(i, " ".join(["word"] * (i % 37))) for i in range(300)], "doc_id long, text string")
    how = Packing(capacity=32, piece=8)
    rows = pack(pieces(docs, PATH, how, ids=True), how).collect()
    padding, held = check(rows, {r.doc_id: r.text for r in docs.collect()}, how)
    assert padding < 0.05 * held
    assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in rows)


def test_awkward_rows(spark):
    docs = awkward(spark, extra=True)
    rows = pack(pieces(docs, PATH)).collect()
    assert sorted(r.doc_tokens for r in rows if r.start == 0) == sorted(len(ids_of(r.text)) for r in docs.collect())
    assert sum(r.length for r in rows) == sum(len(ids_of(r.text)) for r in docs.collect())
    assert pack(pieces(empty(spark), PATH)).count() == 0


def test_one_document_many_times(spark):
    docs = spark.createDataFrame([(7, "the same row again and again")] * 3000, "doc_id long, text string")
    rows = pack(pieces(docs, PATH)).collect()
    assert len(rows) == 3000 and len({r.sequence_id for r in rows}) <= 3000 * 7 // 4096 + 2
