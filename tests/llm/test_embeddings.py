import numpy as np
import pytest

from lexledger.llm import embeddings


def brute(rows):
    ids = [i for i, _ in rows]
    unit = []
    for _, v in rows:
        x = None if v is None or any(c is None for c in v) else np.array(v, float)
        unit.append(x / np.linalg.norm(x) if x is not None and len(x) and np.isfinite(x).all() and np.any(x) else None)
    n, comp = [0] * len(rows), list(range(len(rows)))
    links = [(i, j) for i in range(len(rows)) for j in range(i) if unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.9]

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i, j in links:
        n[i] += 1
        n[j] += 1
        comp[root(i)] = root(j)
    low = {}
    for k, i in enumerate(ids):
        low[root(k)] = min(i, low.get(root(k), i))
    return {i: (n[k], low[root(k)], low[root(k)] == i) for k, i in enumerate(ids)}


def test_links_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(30):
        base = rng.standard_normal(64)
        for _ in range(rng.integers(1, 8)):
            rows.append(base + 0.08 * rng.standard_normal(64))
    dense = rng.standard_normal(64)
    rows += [dense + 0.1 * rng.standard_normal(64) for _ in range(700)]  # more than a block
    rows = [x.tolist() for x in rows] + [rows[0].tolist()] * 3 + [None, [], [0.0] * 64, [float("nan")] * 64, [float("inf")] + [1.0] * 63, [1.0] * 3, [1.0] * 3, [None] + [1.0] * 63, [1e-100] * 64]
    rows = list(zip(rng.permutation(len(rows)).tolist(), rows, strict=True))
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, n_links int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.similar(df).collect()}
    assert got == brute(rows)


def test_recall_at_the_least_similarity():
    """Pairs at a cosine of exactly 0.9 meet in a filter."""
    rng = np.random.default_rng(5)
    a = rng.standard_normal((1500, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((1500, 64))
    b -= (a * b).sum(1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    b = 0.9 * a + np.sqrt(1 - 0.81) * b
    filters = embeddings.Filters(64, 50_000)
    x, y = filters.decode(a), filters.decode(b)
    met = np.mean([len(np.intersect1d(p, q)) > 0 for p, q in zip(x, y, strict=True)])
    assert met >= 0.97
    assert np.mean([len(p) for p in x]) < 60


def test_repeated_ids_keep_their_vectors(spark):
    rng = np.random.default_rng(2)
    a, b, c = (rng.standard_normal(32) for _ in range(3))
    near = lambda x: (x + 0.02 * rng.standard_normal(32)).tolist()
    rows = [(1, a.tolist()), (1, b.tolist()), (2, near(a)), (3, near(b)), (4, c.tolist()), (4, c.tolist()), (5, near(c)), (6, None)]
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in embeddings.similar(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())
    assert got == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False), (4, 2, 4, True), (4, 2, 4, True), (5, 2, 4, False), (6, 0, 6, True)]


def test_other_columns_than_arrays_are_an_error(spark):
    with pytest.raises(TypeError, match="not an array"):
        embeddings.similar(spark.createDataFrame([(1, "x")], "vec_id long, embedding string"))


def test_empty_table(spark):
    assert embeddings.similar(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
