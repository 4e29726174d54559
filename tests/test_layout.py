import math

import numpy as np
import pytest

from voxloom.operators import layout as L
from voxloom.operators import neighbours as N
from voxloom.operators.reduction import reduced
from voxloom.plans.discovery import reduced_by
from voxloom.settings import Settings


def unit_rows(x):
    return x / np.maximum(np.linalg.norm(x, axis=1), 1e-300)[:, None]


def blobs(n, seed=0, width=24, groups=12):
    rng = np.random.default_rng(seed)
    group = rng.integers(0, groups, n)
    return rng.normal(size=(groups, width))[group] + 0.3 * rng.normal(size=(n, width)), group


def table(spark, x, name="row_id"):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], f"{name} long, vec array<double>")


def squares(x):
    return ((x[:, None] - x[None]) ** 2).sum(-1)


def trustworthiness(x, y, k=15):
    """Share of what is near in y that is near in x, weighted by the rank it has there."""
    n, dx, dy = len(x), squares(x), squares(y)
    np.fill_diagonal(dx, -1)
    np.fill_diagonal(dy, np.inf)
    rank = dx.argsort(1).argsort(1)
    near = np.argsort(dy, axis=1)[:, :k]
    return 1 - 2 / (n * k * (2 * n - 3 * k - 1)) * np.maximum(np.take_along_axis(rank, near, 1) - k, 0).sum()


def positions(df):
    return np.array([r.vec for r in df.orderBy("row_id").collect()])


def exact(x, k):
    d = squares(x) / 2
    np.fill_diagonal(d, np.inf)
    return [sorted(zip(row.tolist(), range(len(x))))[:k] for row in d]


def test_one_chunk_is_exact(spark):
    x = unit_rows(np.random.default_rng(3).normal(size=(300, 6)))
    got = {r.id: [e.other for e in r.near] for r in N.neighbour_graph(table(spark, x, "id"), 300, 7, 1).collect()}
    assert got == {i: [o for _, o in near] for i, near in enumerate(exact(x, 7))}


def test_many_chunks_find_nearly_all(spark, monkeypatch):
    monkeypatch.setattr(N, "CHUNK", 100)
    x = unit_rows(blobs(1500)[0])
    near = {r.id: r.near for r in N.neighbour_graph(table(spark, x, "id"), 1500, 15, 1).collect()}
    want = exact(x, 15)
    found = sum(len({e.other for e in near[i]} & {o for _, o in want[i]}) for i in range(1500))
    assert found / (1500 * 15) >= 0.9
    for i, rows in near.items():
        others = [e.other for e in rows]
        assert len(set(others)) == len(others) == 15 and i not in others
        assert [e.d for e in rows] == sorted(e.d for e in rows)
        assert np.allclose([e.d for e in rows], [((x[i] - x[o]) ** 2).sum() / 2 for o in others])


def test_fewer_points_than_neighbours_and_equal_codes(spark):
    few = table(spark, np.eye(4), "id")
    assert all(len(r.near) == 3 for r in N.neighbour_graph(few, 4, 15, 1).collect())
    assert N.neighbour_graph(few.limit(1), 1, 15, 1).count() == 0
    same = table(spark, np.zeros((50, 3)), "id")
    got = N.neighbour_graph(same, 50, 4, 1).collect()
    assert len(got) == 50 and all(len({e.other for e in r.near} - {r.id}) == 4 for r in got)


def test_memberships_add_up_and_unite(spark):
    d = np.sort(np.random.default_rng(0).random((20, 8)), axis=1)
    d[0, 5:] = np.inf
    rho, sigma = L.bandwidths(d, 8)
    assert np.allclose(rho, d[:, 0])
    assert np.allclose(np.exp(-(d - rho[:, None]) / sigma[:, None]).sum(1), math.log2(8), atol=1e-6)
    x = unit_rows(np.random.default_rng(1).normal(size=(60, 4)))
    near = exact(x, 6)
    rho, sigma = L.bandwidths(np.array([[v for v, _ in row] for row in near]), 6)
    one = {(i, o): math.exp(-max(v - rho[i], 0) / sigma[i]) for i, row in enumerate(near) for v, o in row}
    got = {(min(r.a, r.b), max(r.a, r.b)): r.w for r in L.fuzzy_union(N.neighbour_graph(table(spark, x, "id"), 60, 6, 1), 6).collect()}
    want = {}
    for a, b in one:
        v, u = one[a, b], one.get((b, a), 0.0)
        want[min(a, b), max(a, b)] = v + u - v * u
    assert got.keys() == want.keys() and all(abs(got[p] - want[p]) < 1e-6 for p in want)


def test_only_positions_of_other_blocks_travel(spark):
    blocks = spark.createDataFrame([(0, [0.0], 7), (1, [1.0], 7), (2, [2.0], 8)], "id long, vec array<double>, block int")
    edges = spark.createDataFrame([(0, 1, 0.5), (1, 2, 0.25), (2, 0, 0.75)], "a long, b long, w double")
    got = {(r.a, r.b): (r.w, r.own, r.to) for r in L.placed_links(edges, blocks).collect()}
    assert got == {(0, 1): (0.5, 7, None), (1, 2): (0.25, 7, [2.0]), (2, 0): (0.75, 8, [0.0])}


def test_curve():
    # Known values for a spread of 1.
    assert np.allclose(L.curve(0.1), (1.577, 0.895), atol=2e-3)


@pytest.mark.parametrize("chunk,block", [(2048, 4096), (150, 200)])
def test_trustworthiness_above_principal_components(spark, monkeypatch, chunk, block):
    monkeypatch.setattr(N, "CHUNK", chunk)
    monkeypatch.setattr(L, "BLOCK", block)
    x, group = blobs(700)
    rows = table(spark, x)
    laid = positions(reduced_by(rows, 700, 15, Settings(reducer="umap")))
    flat = positions(reduced_by(rows, 700, 15, Settings(reducer="pca")))
    assert laid.shape == (700, 5) and np.isfinite(laid).all()
    assert trustworthiness(unit_rows(x), laid) > trustworthiness(unit_rows(x), flat)
    d = squares(laid)
    np.fill_diagonal(d, np.inf)
    assert (group[d.argmin(1)] == group).mean() > 0.98


def test_trustworthiness_on_the_given_vectors(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").selectExpr("vec_id AS row_id", "embedding AS vec")
    x = unit_rows(positions(rows).astype(float))
    settings = Settings()
    assert trustworthiness(x, positions(L.layout(rows, 20, settings))) > trustworthiness(x, positions(reduced(rows, len(x), settings)))


def test_equal_directions_few_rows_and_unknown_reducer(spark):
    x = np.array([[1.0, 0, 0], [2.0, 0, 0], [0, 1.0, 0], [0, 0, 1.0], [0, 0, 0]])
    laid = positions(L.layout(table(spark, x), 15, Settings()))
    assert np.isfinite(laid).all() and (laid[0] == laid[1]).all() and len(laid) == 5
    for n in (0, 1, 2, 3):
        assert L.layout(table(spark, x).where(f"row_id < {n}"), 15, Settings()).count() == n
    with pytest.raises(ValueError, match="reducer"):
        reduced_by(table(spark, x), 5, 15, Settings(reducer="other"))
