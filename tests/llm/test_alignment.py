import gc
import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lakeload.llm import alignment, hashing
from lakeload.llm.alignment import Aligner, Alignment, PairCounts, byte_level_pieces
from lakeload.llm.common import uncollected
from lakeload.llm.queries import QUERIES
from lakeload.llm.segments import Generations, parts, portions, segments
from llm.helpers import awkward, empty

FIRST, SECOND = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
A = Tokenizer.from_file(FIRST)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=SECOND)
FILES = open(FIRST, encoding="utf-8").read(), open(SECOND, "rb").read(), public_tokenizers.PATTERN
BYTES_A = {i: p for p, i in byte_level_pieces(FILES[0]).items()}


def bytes_b(i):
    piece = B.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if B.is_byte(i) else piece.replace("▁", " ").encode()


def plain(text):
    """(A ids, B ids, groups, links) of a whole text, byte by byte; None without tokens."""
    if not text:
        return None
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    whole = (" " + text).encode()
    if b"".join(BYTES_A[i] for i in a) != whole or b"".join(bytes_b(i) for i in b) != whole:
        return None

    def spans(ids, table):
        at = 0
        for i in ids:
            yield i, at, at + len(table(i))
            at += len(table(i))

    x, y = list(spans(a, BYTES_A.get)), list(spans(b, bytes_b))
    links, j = [], 0
    for i, s, e in x:
        while y[j][2] <= s:
            j += 1
        k = j
        while k < len(y) and y[k][1] < e:
            links.append((i, y[k][0]))
            k += 1
    ends = sorted({e for _, _, e in x} & {e for _, _, e in y})
    groups, s = [], 0
    for e in ends:
        groups.append((
            [i for i, p, q in x if s <= p and q <= e] if len(x) < 300 else None,
            [i for i, p, q in y if s <= p and q <= e] if len(x) < 300 else None,
        ))
        s = e
    if len(x) >= 300:  # the same by walking
        groups, i, j = [], 0, 0
        for e in ends:
            m, n = i, j
            while i < len(x) and x[i][2] <= e:
                i += 1
            while j < len(y) and y[j][2] <= e:
                j += 1
            groups.append(([t for t, _, _ in x[m:i]], [t for t, _, _ in y[n:j]]))
    return a, b, groups, links


def written(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


def wanted(texts):
    """Rows of the contract for texts, by a plain count."""
    found = [plain(t) for t in texts]
    count = Counter(link for f in found if f for link in f[3])
    best = {}
    for (_, b), n in count.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for f in found:
        if f is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, groups, links = f
        out.append((
            len(a), len(b), len(groups), len(links), sum(count[k] == best[k[1]] for k in links),
            sum(count[k] for k in links), hashlib.sha256(written(groups).encode()).hexdigest(),
        ))
    return out


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ALIGNER = Aligner(*FILES, True)
TEXTS = st.text(alphabet=st.one_of(st.sampled_from("   \n\t\x1c\x85 　▁'sé½aab.,.,\n\n1日😀́ɐ<|endoftext|>"), st.characters(exclude_categories=["Cs"])), min_size=1)


@settings(max_examples=400, deadline=None)
@given(TEXTS)
def test_segments_as_whole_texts(text):
    found = ALIGNER.align([p for s in segments(text) for p in parts(" " + s)])
    expected = plain(text)
    if expected is None:
        assert None in found
        return
    a, b, groups, links = expected
    assert None not in found
    assert [sum(p.a for p in found), sum(p.b for p in found), sum(p.groups for p in found)] == [len(a), len(b), len(groups)]
    assert ";".join(p.text for p in found) == written(groups)
    keys = np.frombuffer(b"".join(p.links for p in found), "<u4").tolist()
    assert keys == [i * ALIGNER.width + j for i, j in links]


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    rows = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in QUERIES["op13_alignment"](spark, sf).collect()}
    assert rows == dict(zip([d.doc_id for d in docs], wanted([d.text for d in docs])))


@pytest.mark.parametrize("front", [0, 30, 1 << 22])
def test_pairs_beyond_the_front_are_joined(spark, front, monkeypatch):
    monkeypatch.setattr(hashing, "KEYS", 16)
    monkeypatch.setattr(alignment, "SHARE", 8)
    texts = [f"some words recur, others{i} do not{i % 7} " * (1 + i % 3) for i in range(60)] + ["▁ none", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    ready = Alignment(spark, FIRST, SECOND, public_tokenizers.PATTERN)
    counts = PairCounts(ready.pairs(docs), ready.width, front)
    assert len(counts.front.value[1]) <= front
    rows = ready.score(docs, counts, groups=True).orderBy("doc_id").collect()
    assert [tuple(r[c] for c in COLUMNS) for r in rows] == wanted(texts)
    assert [r.groups for r in rows] == [written(f[2]) if (f := plain(t)) else "" for t in texts]
    counted = {r.pair: r.n for r in counts.counted.collect()}
    assert counted == Counter(i * ready.width + j for t in texts if (f := plain(t)) for i, j in f[3])


def test_awkward_rows(spark):
    docs = awkward(spark, extra=True)
    rows = alignment.align(docs, FIRST, SECOND, public_tokenizers.PATTERN).collect()
    assert sorted(tuple(r[c] for c in COLUMNS) for r in rows) == sorted(wanted([d.text for d in docs.collect()]))
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == sorted((d.doc_id is None, d.doc_id or 0) for d in docs.collect())
    assert alignment.align(empty(spark), FIRST, SECOND, public_tokenizers.PATTERN).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, "▁")], "doc_id long, text string")
    assert {r.n_links for r in alignment.align(nothing, FIRST, SECOND, public_tokenizers.PATTERN).collect()} == {0}


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_minimal_perfect_hash(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 1 << 31, n))
    sizes, bits, ordered = hashing.build(rng.permutation(keys))
    ends = np.cumsum(sizes).tolist()
    table = hashing.Table([(sizes, [bits[s:e] for s, e in zip([0, *ends], ends)])], ordered)
    assert sorted(table.places(keys)) == list(range(len(keys)))
    assert (ordered[table.find(keys)] == keys).all()
    others = np.setdiff1d(rng.integers(0, 1 << 31, 5000), keys)
    assert (table.find(others) == -1).all()


def test_generations_forget_and_make_again():
    made = []
    known = Generations(lambda keys: [made.append(k) or k.upper() for k in keys], 3, 4)
    for _ in range(3):
        assert known.all(["a", "b", "longer"]) == {"a": "A", "b": "B", "longer": "LONGER"}
    assert made.count("a") == 1 and made.count("longer") == 3
    known.all(["c", "d"])
    known.all(["e", "f", "g"])
    known.all(["a"])
    assert made.count("a") == 2


def test_portions_hold_every_text():
    texts = ["a" * 10, "b" * 25, "", "c"]
    assert list(portions(texts, 20)) == [["a" * 10], ["b" * 25], ["", "c"]]


def test_what_is_known_is_not_copied_and_long_keys_go():
    known = Generations(lambda keys: [k.upper() for k in keys], 100, 4)
    first = known.all(["ab", "too long"])
    assert first is known.young and first["too long"] == "TOO LONG"
    assert known.all(["ab", "cd"]) is first and set(first) == {"ab", "cd"}


def test_the_search_for_cycles_rests_and_goes_on():
    with pytest.raises(ValueError), uncollected():
        assert not gc.isenabled()
        raise ValueError
    assert gc.isenabled()
