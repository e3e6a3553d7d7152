import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakeload.llm.codes import Coding, compress, decode, digest, fit, integers, most_exact, nearest, sequency, with_label_error

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, how=Coding()):
    """The contract, vector by vector with Python integers."""
    kept = []
    for vec, embedding, label in rows:
        if embedding and all(x is not None and math.isfinite(x) for x in embedding):
            kept.append((vec, [math.floor(how.scale * x) for x in embedding], label))
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // how.parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    books = [[cut(v, p) for _, v, _ in kept[: how.entries]] for p in range(how.parts)]

    def assign(v, p):
        return min((sum((a - b) ** 2 for a, b in zip(cut(v, p), e)), i) for i, e in enumerate(books[p]))

    for _ in range(how.rounds):
        for p in range(how.parts):
            held = {}
            for _, v, _ in kept:
                held.setdefault(assign(v, p)[1], []).append(cut(v, p))
            for i, own in held.items():
                books[p][i] = [sum(c) // len(own) for c in zip(*own)]
    out = [(vec, [assign(v, p) for p in range(how.parts)], label) for vec, v, label in kept]
    error = {}
    for _, found, label in out:
        error[label] = error.get(label, 0) + sum(d for d, _ in found)
    return sorted(
        ((vec, "".join(f"{i:02x}" for _, i in found), sum(d for d, _ in found), error[label]) for vec, found, label in out),
        key=repr,
    ), np.array(books)


def got(df):
    return sorted(((r.vec_id, r.code, r.error, r.label_error) for r in df.collect()), key=repr)


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 20), st.integers(1, 40), st.sampled_from([1, 3, 40, 1 << 20]), st.integers(0, 1 << 30))
def test_nearest_is_exact(width, entries, most, seed):
    rng = np.random.default_rng(seed)
    parts, book = rng.integers(-most, most + 1, (300, width)), rng.integers(-most, most + 1, (entries, width))
    index, far = nearest(parts, book)
    whole = ((parts[:, None] - book[None]) ** 2).sum(2)
    assert (index == whole.argmin(1)).all() and (far == whole.min(1)).all()


def test_sequency_order():
    h = sequency(16)
    assert ((np.diff(h, axis=1) != 0).sum(1) == np.arange(16)).all()
    assert (h @ h.T == 16 * np.eye(16)).all()


def test_largest_numbers_are_exact():
    most = most_exact(64, Coding())
    parts, book = np.full((1, 16), most), np.array([[-most] * 16, [most - 1] * 16])
    index, far = nearest(parts, book)
    assert index[0] == 1 and far[0] == 16
    assert nearest(parts, book[:1])[1][0] == 16 * (2 * most) ** 2


@pytest.mark.parametrize("seed,entries", [(1, 8), (2, 256), (3, 3)])
def test_as_plain(spark, seed, entries):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, 12))
    rows = [
        (int(rng.integers(0, 150)), (centres[rng.integers(6)] + rng.standard_normal(12) * 0.2).astype(np.float32).tolist(), [None, 1, 2][rng.integers(3)])
        for _ in range(200)
    ]
    how = Coding(entries=entries)
    wanted, books = plain(rows, how)
    found = compress(spark.createDataFrame(rows, SCHEMA), how)
    assert got(found) == wanted
    assert {r.codebooks_sha256 for r in found.collect()} == {digest(books)}


def test_awkward_rows(spark):
    some = [0.5, -1.0, 0.25, 3.0, -0.001, 0.0, 7.5, 1e-9]
    rows = [
        (4, some, 1), (1, None, 1), (2, [], 1), (3, [None] * 8, 2), (5, [float("nan")] * 8, 2), (6, [float("inf")] * 8, None),
        (4, some, 1), (None, [x + 1 for x in some], None), (9, [1.0, 2.0], 3), (10, [3e30] * 8, 3), (11, [-x for x in some], None),
    ]
    df = spark.createDataFrame([(*r, 0.5, "x") for r in rows], f"{SCHEMA}, error double, code string")
    wanted, _ = plain([r for r in rows if r[0] not in (9, 10)])
    assert got(compress(df)) == wanted
    assert compress(spark.createDataFrame([], SCHEMA)).count() == 0


def test_lengths_that_parts_do_not_divide(spark):
    rows = [(i, [float(i), 1.0, -2.0, 0.5, i / 2], 0) for i in range(9)]
    padded = [(i, [*v, 0.0, 0.0, 0.0], label) for i, v, label in rows]
    assert got(compress(spark.createDataFrame(rows, SCHEMA))) == plain(padded)[0]


def test_many_labels_and_one_large(spark, monkeypatch):
    coded = spark.range(2000).selectExpr("id as vec_id", "if(id % 3 = 0, null, cast(id as int)) as label", "'00' as code", "id as error")
    usual = sorted(map(repr, with_label_error(coded).collect()))
    monkeypatch.setattr("lakeload.llm.codes.LABELS", 5)
    assert sorted(map(repr, with_label_error(coded).collect())) == usual


def test_decoded_vectors(spark):
    rows = [(i, [i / 4, 1.0, -2.5, 0.5], 0) for i in range(5)]
    vectors = integers(spark.createDataFrame(rows, SCHEMA))
    books = fit(vectors)
    coded = compress(spark.createDataFrame(rows, SCHEMA))
    back = {r.vec_id: r.v for r in coded.select("vec_id", decode(coded.code, books).alias("v")).collect()}
    assert back == {i: v for i, v, _ in rows}
