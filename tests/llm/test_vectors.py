import numpy as np

from lakeload.llm.queries import QUERIES
from lakeload.llm.vectors import Index, fit, near_vectors
from llm.helpers import groups


def plain(ids, vectors, cosine=0.95):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    linked = unit @ unit.T >= cosine
    np.fill_diagonal(linked, False)
    root = groups([(ids[i], ids[j]) for i, j in zip(*np.nonzero(linked))], ids)
    return {ids[i]: (int(linked[i].sum()), root[ids[i]]) for i in range(len(ids))}


def close_to(rng, base, cosine):
    unit = base / np.linalg.norm(base, axis=1, keepdims=True)
    aside = rng.standard_normal(base.shape)
    aside -= (aside * unit).sum(1, keepdims=True) * unit
    aside /= np.linalg.norm(aside, axis=1, keepdims=True)
    return cosine[:, None] * unit + np.sqrt(1 - cosine**2)[:, None] * aside


def test_against_all_pairs(spark):
    rng = np.random.default_rng(1)
    far = rng.standard_normal((1500, 32))
    near = close_to(rng, far[:300], rng.uniform(0.93, 0.999, 300))
    crowd = close_to(rng, np.repeat(far[:1], 500, 0), rng.uniform(0.96, 1, 500))
    vectors = np.concatenate([far, near, crowd, far[:50], 3 * far[:50]])
    ids = [int(i) for i in rng.permutation(len(vectors))]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in zip(ids, vectors)], "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(df).collect()}
    want = plain(ids, vectors)
    assert all(got[i][0] <= want[i][0] for i in ids)
    assert sum(g[0] for g in got.values()) >= 0.98 * sum(w[0] for w in want.values())
    assert sum(got[i][1] != want[i][1] for i in ids) <= 0.01 * len(ids)


def test_cells_are_the_nearest_in_order():
    rng = np.random.default_rng(2)
    sample = rng.standard_normal((600, 12))
    index = fit(sample, 64 * 64, 0.95, 0.99)
    index = Index(index.books, 20)
    first, second = index.distances(sample[:40])
    total = (first[:, :, None] + second[:, None, :]).reshape(40, -1)
    cells = index.cells(sample[:40])
    for row, got in zip(total, cells):
        assert np.allclose(row[got], np.sort(row)[: len(got)]) and len(set(got)) == 20


def test_query(spark):
    path = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{path}/embeddings.parquet").collect()
    got = {r.vec_id: (r.n_links, r.component_id) for r in QUERIES["op9_embeddings"](spark, path).collect()}
    assert got == plain([r.vec_id for r in rows], np.array([r.embedding for r in rows], float))


def test_awkward_rows(spark):
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]),
        (7, [1.0, 0.0]), (7, [1.0, 0.0]), (8, [2.0, 0.0]), (9, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (None, [0.0, 1.0]),
        (10, [1e30, 1e28]), (11, [-1.0, 0.0]),
    ]
    got = sorted(map(str, (tuple(r) for r in near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect())))
    want = [(i, 0, i, True) for i in (1, 2, 3, 4, 5, 6, 9, 11, None)]
    want += [(7, 4, 7, True)] * 2 + [(8, 4, 7, False), (10, 4, 7, False), (None, 4, 7, False)]
    assert got == sorted(map(str, want))
    assert near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
