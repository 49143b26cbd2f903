import numpy as np
import pytest

from outletry.llm import vectors
from outletry.llm.blocks import labels
from outletry.llm.components import components


def brute(v: np.ndarray, least: float):
    u = v / np.linalg.norm(v, axis=1)[:, None]
    near = u @ u.T >= least
    return near.sum(1) - 1, labels(len(v), *np.nonzero(near))


def clusters(seed: int, groups: list[int], dim: int = 32) -> np.ndarray:
    r = np.random.default_rng(seed)
    rows = []
    for n in groups:
        c = r.normal(size=dim)
        rows += [c / np.linalg.norm(c) + r.normal(size=dim) * 0.05 / np.sqrt(dim) * r.uniform(0, 6) for _ in range(n)]
    return np.array(rows, np.float32).astype(float)


def test_equals_brute_force(spark):
    v = clusters(1, [1] * 300 + [2] * 60 + [7] * 20 + [90, 150])
    d = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>").repartition(3)
    for at in (vectors.Hashing(), vectors.Hashing(chunk=40)):
        got = vectors.near_duplicates(d, at=at).toPandas().sort_values("vec_id")
        links, comp = brute(v, 0.95)
        assert (got.n_links.to_numpy() <= links).all() and got.n_links.sum() >= 0.97 * links.sum()
        assert (got.component_id.to_numpy() == comp).mean() > 0.98
        assert (got.kept == (got.vec_id == got.component_id)).all()


@pytest.mark.parametrize("n, dim", [(1000, 64), (50_000, 64), (10**8, 64), (10**11, 64), (10**6, 768), (10**11, 768), (100, 3)])
def test_pairs_share_a_bucket_with_the_recall(n, dim):
    at = vectors.Hashing()
    hashes, tables = vectors.plan(n, dim, at)
    r = np.random.default_rng(n + dim)
    a, b = r.normal(size=(2, 1500, dim))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b -= np.einsum("ij,ij->i", a, b)[:, None] * a
    b = 0.95 * a + np.sqrt(1 - 0.95**2) * b / np.linalg.norm(b, axis=1)[:, None]
    x, y = vectors.keys(a, hashes, tables, at), vectors.keys(b, hashes, tables, at)
    assert np.mean([bool(set(p) & set(q)) for p, q in zip(x.tolist(), y.tolist())]) >= 0.995
    assert tables <= at.most_tables or hashes == 1


def test_several_hashes_find_all_links(spark):
    v = clusters(3, [1] * 100 + [2] * 40 + [30], 24)
    v = np.concatenate([v, np.repeat(v[-3:], 40, 0)])  # copies, a class each
    d = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>").repartition(3)
    links, comp = brute(v, 0.95)
    got = vectors.near_duplicates(d, at=vectors.Hashing(bucket=1e-4, chunk=25)).toPandas().sort_values("vec_id")
    assert vectors.plan(len(v), 24, vectors.Hashing(bucket=1e-4))[0] >= 3
    assert (got.n_links.to_numpy() <= links).all() and got.n_links.sum() >= 0.99 * links.sum() and (got.component_id.to_numpy() == comp).mean() > 0.98


def test_hadamard_is_orthogonal():
    h = vectors.hadamard(np.eye(16))
    assert np.allclose(h @ h.T, 16 * np.eye(16)) and set(np.unique(h)) == {-1.0, 1.0}


@pytest.mark.parametrize("small", [1_000_000, 0])
def test_components(spark, small):
    r = np.random.default_rng(2)
    pairs = [(i, i + 1) for i in range(1000, 1040)] + [(5000, k) for k in range(6000, 6400)] + [(7, 7)] + [tuple(map(int, x)) for x in r.integers(0, 300, (200, 2))]
    d = spark.createDataFrame(pairs, "a long, b long").repartition(3)
    got = {x["id"]: x["component"] for x in components(d, small=small).collect()}
    ids = sorted({x for p in pairs if p[0] != p[1] for x in p})
    at = {x: k for k, x in enumerate(ids)}
    lab = labels(len(ids), *np.array([(at[a], at[b]) for a, b in pairs if a != b]).T)
    assert got == {x: ids[lab[k]] for x, k in at.items()}
    assert components(d.limit(0), small=small).count() == 0


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (9, [1.0]), (None, [1.0, 0.01]), (1, [1.0, 0.0])]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as uid", "2 as v", "3 as key", "4 as block")
    got = sorted((x["vec_id"] or 0, x["n_links"], x["component_id"]) for x in vectors.near_duplicates(d).collect())
    assert got == [(0, 3, 1), (1, 3, 1), (1, 3, 1), (2, 3, 1), *[(i, 0, i) for i in range(3, 10)]]
    assert vectors.near_duplicates(d.limit(0)).count() == 0
