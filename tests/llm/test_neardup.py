import random

import numpy as np
import pytest

from lakeload.llm import components as connected
from lakeload.llm import neardup
from lakeload.llm.common import stored
from lakeload.llm.components import components
from lakeload.llm.neardup import Hasher, Near, Sketcher, near_duplicates, without_copies
from lakeload.llm.queries import QUERIES
from llm.helpers import awkward, empty, groups, prose


def shingles(text, k):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)} if words else set()


def plain(texts, k):
    """Number of shingles and component of each id, from all pairs."""
    sets = {i: shingles(t, k) for i, t in texts.items()}
    ids = sorted(sets)
    links = []
    for n, i in enumerate(ids):
        for j in ids[:n]:
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                links.append((i, j))
    root = groups(links, ids)
    return {i: (len(sets[i]), root[i]) for i in ids}


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_against_all_pairs(spark, sf):
    path = f"/root/testdata/sf{sf}"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    rows = QUERIES["op7_minhash"](spark, path).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == plain(texts, 2)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def varied(rng, words, change):
    """Some words replaced, in one stretch, so that similarity is easy to aim at."""
    out, at = list(words), rng.randrange(len(words) - change)
    out[at : at + change] = [f"n{rng.randrange(10**9)}" for _ in range(change)]
    return out


def test_group_whose_members_differ_from_each_other(spark):
    """Copies linked through others: chains, and members that miss the centre but not a neighbour."""
    rng = random.Random(8)
    base = prose(1, 200, 10**6).split()
    texts = [base]
    for _ in range(60):
        texts.append(varied(rng, texts[rng.randrange(len(texts))], rng.choice([6, 12, 18])))
    texts += [prose(100 + i, rng.randrange(1, 60)).split() for i in range(60)]
    rows = {i: " ".join(t) for i, t in enumerate(texts)}
    df = spark.createDataFrame([(i, t) for i, t in rows.items()], "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(df, Near(words=2)).collect()}
    assert got == plain(rows, 2)


def test_sketch_estimates_similarity():
    rng = random.Random(3)
    words = prose(5, 400, 10**6).split()
    sketcher, hasher = Sketcher(Near(words=2, bands=300, rows=1)), Hasher(2)
    for change, size in [(20, 400), (60, 400), (2, 12)]:
        a = words[:size]
        b = varied(rng, a, change)
        sets = [shingles(" ".join(x), 2) for x in (a, b)]
        true = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
        keys = [sketcher.bands(hasher.shingles(" ".join(x).encode())) for x in (a, b)]
        assert np.mean(keys[0] == keys[1]) == pytest.approx(true, abs=0.12)


def test_components(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(400 + i, 401 + i) for i in range(40)] + [(500, 500)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = groups(edges, {x for e in edges for x in e})
    assert got == {i: want[i] for i in got} and set(got) == {x for a, b in edges if a != b for x in (a, b)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_awkward_rows(spark):
    docs = awkward(spark, extra=True)
    rows = near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    of = {}
    for r in rows:
        of.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id))
    assert of[1] == [(0, 1)] and of[3] == [(0, 3)] and of[7] == [(1, 7)] * 2 and of[10] == [(1, 7)]
    kept = without_copies(docs)
    assert kept.columns == docs.columns
    texts = [r.text for r in kept.collect()]
    assert texts.count("same row twice in here") == 1 and texts.count("no id here at all") == 1
    assert sum(not (t or "").strip() for t in texts) == 4
    assert near_duplicates(empty(spark)).count() == 0 and without_copies(empty(spark)).count() == 0


def test_plans_stay_small(spark, monkeypatch):
    """The driver keeps each plan, and sends it on with each of its stages: none reads a stored table many times over."""
    scans = {}

    def noted(df, name):
        plan = df._jdf.queryExecution().executedPlan().toString()
        scans[name] = max(scans.get(name, 0), plan.count("FileScan"))
        return stored(df, name)

    monkeypatch.setattr(connected, "stored", noted)
    monkeypatch.setattr(neardup, "stored", noted)
    rng = random.Random(2)
    base = prose(1, 200, 10**6).split()
    texts = [" ".join(varied(rng, base, rng.choice([6, 12, 18]))) for _ in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(df, Near(words=2)).collect()}
    assert got == plain(dict(enumerate(texts)), 2)
    assert scans["edges"] <= 4 and scans["more-links"] <= 4
