import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeload.llm.bpe import Bpe, Encoder, Frequent, at_most, byte_pairs, fold, folded, load_ranks, uneven
from lakeload.llm.queries import QUERIES, VOCABULARY
from llm.helpers import awkward, empty

RANKS = load_ranks(VOCABULARY)
TIKTOKEN = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ENCODER = Encoder(RANKS, public_tokenizers.PATTERN)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\x0b\x1c\x85\u00a0\u3000'sltré1½.,aé日😀"), st.characters(exclude_categories=["Cs"]))))
def test_as_tiktoken(text):
    ids = ENCODER.encode(text).tolist()
    assert ids == TIKTOKEN.encode_ordinary(text)
    assert ENCODER.decode(ids) == text.encode()


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from(" \n\t\0\x1c\u00a0\u2003\u3000'stré1.,日")))
def test_known_words_and_stretches_as_tiktoken(text):
    known = {w: np.array(fold(w.encode(), RANKS), np.uint16).tobytes() for w in ENCODER.find(text)}
    for encoder in (Encoder(RANKS, public_tokenizers.PATTERN, known), ENCODER):
        for again in (text, " " + text, text.replace("\n", " ")):
            assert encoder.encode(again).tolist() == TIKTOKEN.encode_ordinary(again)
    assert uneven(text) == bool(re.search(r" \s|\s ", text))


def test_pairs_of_bytes_change_no_fold():
    pairs, rng = byte_pairs(RANKS), random.Random(5)
    for size in range(60):
        word = bytes(rng.choice(b" abehnrst\xc3\xa9\xe6") for _ in range(size))
        assert fold(word, RANKS, pairs) == fold(word, RANKS) == (TIKTOKEN._encode_single_piece(word) if word else [])


def test_a_word_is_remembered_once():
    """What a worker keeps beside the frequent words stays small: a single word is a stretch and nothing else."""
    encoder = Encoder(RANKS, public_tokenizers.PATTERN, {" the": np.array(fold(b" the", RANKS), np.uint16).tobytes()})
    encoder.encode("x the, thablesh the. thoreed thablesh,")
    assert set(encoder.stretches) == {" thablesh", " thoreed"} and set(encoder.words) == {"x"}


def test_the_driver_holds_buffers_of_frequent_words(spark):
    words = [" the", "\n", "é\0", " thoreed"]
    ids = [fold(w.encode(), RANKS) for w in words]
    for kind in (np.uint16, np.uint32):
        table = pa.table({"word": pa.array(words), "ids": pa.array(ids, pa.list_(pa.int32()))})
        found = Frequent.of(pa.concat_tables([table.slice(0, 1), table.slice(1)]), kind).by_word()
        assert {w: np.frombuffer(b, kind).tolist() for w, b in found.items()} == dict(zip(words, ids))
        assert Frequent.of(table.slice(0, 0), kind).by_word() == {}
    docs = spark.createDataFrame([(1, "the the thoreed")], "doc_id long, text string")
    held = Bpe(spark, VOCABULARY, public_tokenizers.PATTERN).prepare(docs).shared.value[1]
    assert isinstance(held, Frequent) and set(held.by_word()) == {"the", " the", " thoreed"}


def test_long_words():
    rng = random.Random(2)
    for text in ["a" * 3000, " " * 2000 + "x", "ab" * 2000, "".join(rng.choice("abcdefgh") for _ in range(3000)), "日" * 500]:
        assert ENCODER.encode(text).tolist() == TIKTOKEN.encode_ordinary(text)


def test_folded_by_spark(spark):
    words = sorted({w for t in [" theandof shthble\n\n=== éèü 日本 'll 123 x", "Lyornt ndorbleainea!!!"] for w in ENCODER.find(t)} | {" ", "a"})
    rows = spark.createDataFrame([(w,) for w in words], "word string").select("word", folded(F.col("word"), RANKS).alias("ids")).collect()
    assert {r.word: r.ids for r in rows} == {w: fold(w.encode(), RANKS) for w in words}


def test_at_most_keeps_the_commonest(spark):
    counted = spark.createDataFrame([(f"w{i}", 1 + i * i) for i in range(200)], "word string, n long")
    kept = [r.n for r in at_most(counted, 50).collect()]
    assert 0 < len(kept) <= 50 and min(kept) == sorted((1 + i * i for i in range(200)), reverse=True)[len(kept) - 1]


def test_query_as_tiktoken(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in QUERIES["op3_bpe"](spark, sf).collect():
        ids = TIKTOKEN.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


@pytest.mark.parametrize("prepared", [True, False])
def test_awkward_rows_round_trip(spark, prepared):
    docs = awkward(spark, extra=True)
    coder = Bpe(spark, VOCABULARY, public_tokenizers.PATTERN)
    coder = coder.prepare(docs) if prepared else coder
    encoded = coder.encode(docs, ["doc_id", "n"])
    back = coder.decode(encoded, ["doc_id"]).collect()
    assert sorted(bytes(r.bytes) for r in back) == sorted((r.text or "").encode() for r in docs.collect())
    assert coder.encode(empty(spark), ["doc_id"]).count() == 0
    assert Bpe(spark, VOCABULARY, public_tokenizers.PATTERN).prepare(empty(spark)).encode(docs, ["doc_id"]).count() == docs.count()
