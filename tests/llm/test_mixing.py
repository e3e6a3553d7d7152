import pytest

from lakeload.llm.mixing import _meet, mix, mixed_documents
from llm.helpers import awkward, empty, prose


def plain_targets(sizes, weights=(5, 2, 1), most=3.0):
    """Sources in order, null last; share by weight, stop at the cap, reshare the excess."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = [s for s in rest if share[s] > most * sizes[s]]
        if not over:
            return {**capped, **share}
        capped |= {s: most * sizes[s] for s in over}


@pytest.fixture
def sized(spark):
    rows, sources = [], ["a", "b", "hot", None, "tiny"]
    for i in range(1500):
        source = "hot" if i % 3 == 0 else sources[i % 5] if i % 50 else "tiny"
        rows.append((i, prose(i, 1 + (i * 37) % 90), "en", source, 0))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_targets_and_taken(spark, sized):
    rows = mix(sized).collect()
    sizes, taken, longest = {}, {}, {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
        taken[r.source] = taken.get(r.source, 0) + r.size * r.copies
        longest[r.source] = max(longest.get(r.source, 0), r.size)
        assert 0 <= r.copies <= 3
    want = plain_targets(sizes)
    for r in rows:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= longest[s] / 2 + 1
    again = mix(sized.repartition(7)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_meeting_keeps_words_and_has_no_bias():
    for a, p, b, q in [(5, 0.3, 9, 0.7), (100, 0.5, 1, 0.5), (3, 0.99, 3, 0.01)]:
        ends = [_meet(a, p, b, q, d / 1000 + 0.0005) for d in range(1000)]
        for x, y in ends:
            assert a * x + b * y == pytest.approx(a * p + b * q)
            assert min(abs(x), abs(1 - x), abs(y), abs(1 - y)) < 1e-9
        assert sum(x for x, _ in ends) / 1000 == pytest.approx(p, abs=0.01)
        assert sum(y for _, y in ends) / 1000 == pytest.approx(q, abs=0.01)


def test_awkward_rows(spark):
    docs = awkward(spark, extra=True)
    m = mix(docs)
    rows = m.collect()
    assert len(rows) == docs.count()
    mixed = mixed_documents(docs, m)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r.copies for r in rows)
    assert mix(empty(spark)).count() == 0
    assert mixed_documents(empty(spark), mix(empty(spark))).count() == 0


def test_hot_row_is_combined(spark):
    docs = spark.createDataFrame([(1, "a b c", "en", "s", 5)] * 5000 + [(2, "d", "en", "t", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    rows = mix(docs).collect()
    assert len(rows) == 5001 and {r.copies for r in rows if r.doc_id == 1} <= {0, 1, 2}
