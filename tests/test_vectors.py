"""Vector operators against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxloom.operators import metrics as M
from voxloom.operators import representatives as R
from voxloom.operators.arrays import centroids
from voxloom.operators import hierarchy, spanning
from voxloom.operators.density import density_cluster, weighted_points
from voxloom.operators.nearest import best_match
from voxloom.operators.reduction import reduced
from voxloom.settings import Settings

SETTINGS = Settings()


def table(spark, rows, schema):
    return spark.createDataFrame([tuple(r) for r in rows], schema)


@pytest.fixture(scope="module")
def sample():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 6))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return x, rng.integers(-1, 4, 60)


def members(spark, sample, texts=None):
    x, y = sample
    texts = texts or [f"text number {i}" for i in range(len(x))]
    rows = [(i, int(t), texts[i], texts[i], v.tolist()) for i, (t, v) in enumerate(zip(y, x))]
    return table(
        spark, rows, "row_id long, topic_id int, original_comment string, cleaned_text string, vec array<double>"
    )


def test_centroids(spark, sample):
    x, y = sample
    got = {r.topic_id: r for r in centroids(members(spark, sample)).collect()}
    assert set(got) == set(y[y >= 0].tolist())
    for t, r in got.items():
        assert r.n == (y == t).sum() and np.allclose(r.centroid, x[y == t].mean(axis=0))


@pytest.mark.parametrize("limit", [32 * 1024 * 1024, 200])
def test_best_match_by_broadcast_and_by_blocks(spark, sample, limit):
    x, y = sample
    ids = np.arange(len(x))
    rows = table(spark, [(int(i), int(i), v.tolist()) for i, v in zip(ids, x)], "id long, skip long, vec array<double>")
    refs = rows.select("id", "vec")
    got = {r.id: r for r in best_match(rows, refs, Settings(broadcast_bytes=limit)).collect()}
    scores = x @ x.T
    own = scores.diagonal().copy()
    np.fill_diagonal(scores, -np.inf)
    assert len(got) == len(x)
    for i in ids:
        assert got[i].match_id == scores[i].argmax()
        assert got[i].score == pytest.approx(scores[i].max(), abs=1e-8)
        assert got[i].own_score == pytest.approx(own[i], abs=1e-8)


def test_best_match_without_another_reference(spark):
    one = table(spark, [(7, 7, [1.0, 0.0])], "id long, skip long, vec array<double>")
    row = best_match(one, one.select("id", "vec"), SETTINGS).first()
    assert row.match_id is None and row.score is None and row.own_score == pytest.approx(1)


def brute_silhouette(x, y):
    d = 1 - x @ x.T
    out = []
    for i in range(len(x)):
        same = (y == y[i]) & (np.arange(len(x)) != i)
        if not same.any():
            out.append(0.0)
            continue
        a = d[i, same].mean()
        b = min(d[i, y == t].mean() for t in set(y.tolist()) - {y[i]})
        out.append((b - a) / max(a, b))
    return float(np.mean(out))


def test_silhouette(spark, sample):
    x, y = sample
    y = y.copy()
    y[y == 3] = -1
    y[0] = 3  # a topic of one
    got = M.silhouette(members(spark, (x, y)), SETTINGS).first()[0]
    assert got == pytest.approx(brute_silhouette(x[y >= 0], y[y >= 0]), abs=1e-9)


def test_silhouette_undefined(spark, sample):
    x, y = sample
    assert M.silhouette(members(spark, (x, np.zeros_like(y))), SETTINGS).first()[0] is None
    assert M.silhouette(members(spark, (x[:5], np.arange(5))), SETTINGS).first()[0] is None


def brute_representatives(x, y, texts, flags, topic, k):
    idx = np.where(y == topic)[0]
    c = x[idx].mean(axis=0)
    sims = x[idx] @ c / (np.linalg.norm(x[idx], axis=1) * np.linalg.norm(c) + 1e-9)
    seen, unique = set(), []
    for i in idx[np.argsort(-sims, kind="stable")]:
        if texts[i].lower() not in seen:
            seen.add(texts[i].lower())
            unique.append(int(i))
    chosen, rest = unique[:k], unique[k:]
    if len({flags[i] for i in chosen}) == 1:
        other = [i for i in rest if flags[i] != flags[chosen[0]]]
        if other:
            chosen[-1] = other[0]
    return chosen


@pytest.mark.parametrize("k", [1, 3, 8])
def test_representatives(spark, sample, k):
    x, y = sample
    texts = [("نص" if i % 7 == 0 else "Text") + f" {i // 2}" for i in range(len(x))]
    flags = [t.startswith("نص") for t in texts]
    got = {}
    for r in R.representatives(members(spark, sample, texts), SETTINGS, k).orderBy("topic_id", "rank").collect():
        got.setdefault(r.topic_id, []).append(r.row_id)
    assert got == {t: brute_representatives(x, y, texts, flags, t, k) for t in set(y[y >= 0].tolist())}


def test_reduced_matches_svd(spark, sample):
    x, _ = sample
    rows = table(spark, [(i, v.tolist()) for i, v in enumerate(x)], "row_id long, vec array<double>")
    got = np.array([r.vec for r in reduced(rows, len(x), SETTINGS).orderBy("row_id").collect()])
    centred = x - x.mean(axis=0)
    u, s, vt = np.linalg.svd(centred, full_matrices=False)
    loadings = vt[:5]
    signs = np.sign(loadings[np.arange(5), np.abs(loadings).argmax(axis=1)])
    assert got == pytest.approx(centred @ loadings.T * signs, abs=1e-6)


def blobs():
    rng = np.random.default_rng(7)
    centers = rng.uniform(-10, 10, (4, 5))
    x = np.vstack([c + rng.normal(0, 0.5, (60, 5)) for c in centers] + [rng.uniform(-15, 15, (30, 5))])
    return x, np.repeat([0, 1, 2, 3, -1], [60, 60, 60, 60, 30])


def rand_index(a, b):
    """Adjusted Rand index."""
    pairs = lambda n: n * (n - 1) / 2
    _, a = np.unique(a, return_inverse=True)
    _, b = np.unique(b, return_inverse=True)
    table_ = np.zeros((a.max() + 1, b.max() + 1))
    np.add.at(table_, (a, b), 1)
    both, rows, cols = pairs(table_).sum(), pairs(table_.sum(1)).sum(), pairs(table_.sum(0)).sum()
    expected = rows * cols / pairs(len(a))
    return (both - expected) / ((rows + cols) / 2 - expected)


def points(spark, x):
    return table(spark, [(i, v.tolist()) for i, v in enumerate(x)], "row_id long, vec array<double>")


def test_density_finds_blobs_and_noise(spark):
    x, y = blobs()
    got = np.array([r.topic_id for r in density_cluster(points(spark, x), 10, 4, SETTINGS).orderBy("row_id").collect()])
    assert rand_index(got, y) > 0.9
    assert (got[y == -1] == -1).mean() > 0.7 and set(got.tolist()) == {-1, 0, 1, 2, 3}


def brute_density(x, size, reach):
    """Single linkage over mutual reachability, condensed edge by edge, excess of mass."""
    n = len(x)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    core = np.sort(d, axis=1)[:, reach - 1]
    m = np.maximum(d, np.maximum(core[:, None], core[None]))

    def parts(nodes, limit):
        left, out = set(nodes), []
        while left:
            stack, comp = [left.pop()], []
            while stack:
                a = stack.pop()
                comp.append(a)
                near = [b for b in left if m[a, b] < limit]
                left -= set(near)
                stack += near
            out.append(comp)
        return out

    def grow(nodes, birth):
        """(value, chosen clusters) of the cluster born with these nodes."""
        start, stability = list(nodes), 0.0
        while True:
            limit = link(nodes)
            density = 1 / limit
            large = [p for p in parts(nodes, limit) if len(p) >= size]
            if len(large) == 1:
                stability += (len(nodes) - len(large[0])) * (density - birth)
                nodes = large[0]
                continue
            stability += len(nodes) * (density - birth)
            below = [grow(p, density) for p in large]
            total = sum(v for v, _ in below)
            if total > stability:
                return total, [c for _, cs in below for c in cs]
            return stability, [start]

    def link(nodes):
        """Largest edge of the spanning tree of these nodes."""
        inside, best = [nodes[0]], m[nodes[0], nodes].copy()
        out, largest = np.ones(len(nodes), bool), 0.0
        out[0] = False
        while out.any():
            at = np.where(out, best, np.inf).argmin()
            largest = max(largest, best[at])
            out[at] = False
            best = np.minimum(best, m[nodes[at], nodes])
            inside.append(nodes[at])
        return largest

    labels = np.full(n, -1)
    nodes = list(range(n))
    while True:  # the root itself is never chosen
        limit = link(nodes)
        large = [p for p in parts(nodes, limit) if len(p) >= size]
        if len(large) != 1:
            break
        nodes = large[0]
    chosen = [c for p in large for c in grow(p, 1 / limit)[1]]
    for number, cluster in enumerate(sorted(chosen, key=min)):
        labels[cluster] = number
    return labels


@pytest.mark.parametrize("seed", [1, 2])
def test_density_equals_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    angle = rng.uniform(0, np.pi, 70)
    moon = np.c_[np.cos(angle), np.sin(angle)]
    x = np.vstack([moon, [1, 0.4] - moon, rng.uniform(-2, 3, (20, 2))]) + rng.normal(0, 0.08, (160, 2))
    got = [r.topic_id for r in density_cluster(points(spark, x), 8, 4, SETTINGS).orderBy("row_id").collect()]
    assert got == brute_density(x, 8, 4).tolist()


def test_density_reads_all_levels(spark):
    """The second largest gap alone says that the right group is one cluster: that level may not be left out."""
    gaps = np.random.default_rng(5).uniform(0.8, 0.9, 1199)
    gaps[399], gaps[799] = 100, 1
    x = np.r_[0, gaps.cumsum()][:, None]
    got = [r.topic_id for r in density_cluster(points(spark, x), 100, 1, SETTINGS).orderBy("row_id").collect()]
    assert got == [0] * 400 + [1] * 800


def test_density_counts_copies_as_weight(spark):
    x, _ = blobs()
    x = np.vstack([x, np.repeat(x[:1], 200, axis=0)])
    single = weighted_points(points(spark, x))
    assert single.agg(F.max("weight"), F.sum("weight"), F.count("*")).first() == (201, len(x), len(x) - 200)
    assert sorted(r.id for r in single.collect()) == list(range(len(x) - 200))
    got = [r.topic_id for r in density_cluster(points(spark, x), 10, 4, SETTINGS).orderBy("row_id").collect()]
    assert got[0] >= 0 and set(got[270:]) == {got[0]}


@pytest.mark.parametrize("seed,cell,range_", [(1, 4096, 1 << 17), (2, 120, 70)])
def test_density_over_many_cells_and_ranges(spark, monkeypatch, seed, cell, range_):
    """Small cells of space and ranges of weight give the labels of brute force; copies are weights."""
    monkeypatch.setattr(spanning, "CELL", cell)
    monkeypatch.setattr(spanning, "LEAF", 8)
    monkeypatch.setattr(hierarchy, "RANGE", range_)
    rng = np.random.default_rng(seed)
    x = np.vstack([rng.normal(c, s, (n, 2)) for c, s, n in [((0, 0), 0.3, 70), ((3, 0), 0.2, 50), ((3, 1), 0.1, 30), ((0, 5), 1, 40)]])
    x = np.vstack([x, rng.uniform(-3, 7, (30, 2)), np.repeat(x[:1], 5, axis=0), np.repeat(x[100:101], 7, axis=0)])
    x = x[rng.permutation(len(x))]
    got = [r.topic_id for r in density_cluster(points(spark, x), 10, 4, SETTINGS).orderBy("row_id").collect()]
    assert got == brute_density(x, 10, 4).tolist()


def brute_tree_weights(x, reach):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    core = np.sort(d, axis=1)[:, reach - 1]
    m = np.maximum(d, np.maximum(core[:, None], core[None]))
    best, out, found = m[0].copy(), np.ones(len(x), bool), []
    out[0] = False
    while out.any():
        at = np.where(out, best, np.inf).argmin()
        found.append(best[at])
        out[at] = False
        best = np.minimum(best, m[at])
    return np.sort(found)


@pytest.mark.parametrize("cell", [4096, 200])
def test_spanning_tree_of_two_thousand_points(spark, monkeypatch, cell):
    monkeypatch.setattr(spanning, "CELL", cell)
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(rng.uniform(-5, 5, 5), 0.4, (300, 5)) for _ in range(6)] + [rng.uniform(-8, 8, (200, 5))])
    single = weighted_points(points(spark, x))
    placed, cells, n = spanning.dealt(single, 1)
    tree = spanning.spanning_tree(spanning.core_distances(placed, 8), cells).toPandas()
    above, kept = list(range(n)), []

    def top(k):
        while above[k] != k:
            k = above[k]
        return k

    for a, b, w in tree.sort_values("w")[["a", "b", "w"]].itertuples(index=False):
        a, b = top(int(a)), top(int(b))
        if a != b:  # of edges of one weight there may be one too many
            above[a] = b
            kept.append(w)
    assert n == len(x) and n - 1 <= len(tree) < 1.01 * n
    assert np.allclose(kept, brute_tree_weights(x, 8), rtol=1e-12)


def test_components_of_a_path_and_a_star(spark, monkeypatch):
    monkeypatch.setattr(spanning, "FEW", 0)
    rows = [(k, k + 1) for k in range(100, 140)] + [(7, 200 + k) for k in range(30)] + [(7, 7), (300, 300), (50, 9)]
    got = {r.id: r.component for r in spanning.components(table(spark, rows, "u long, v long")).collect()}
    assert got == {k: 100 for k in range(100, 141)} | {k: 7 for k in [7, *range(200, 230)]} | {9: 9, 50: 9}


def test_long_runs_of_clusters_are_valued_in_few_rounds(spark):
    """A comb: every cluster of the spine has one leaf beside the next one."""
    rng = np.random.default_rng(6)
    n, rows = 60, []
    for k in range(n):
        rows.append((2 * k, 2 * (k - 1) if k else None, float(rng.uniform(0, 6))))
        rows.append((2 * k + 1, 2 * k, float(rng.uniform(0, 1))))
    s, kids = {c: v for c, _, v in rows}, {}
    for c, p, _ in rows:
        kids.setdefault(p, []).append(c)
    val = {}
    for c, _, _ in reversed(rows):
        val[c] = max(s[c], sum(val[k] for k in kids.get(c, [])))
    clusters = table(spark, rows, "c long, parent long, s double")
    got = {r.c: r.val for r in hierarchy.best_values(clusters).collect()}
    assert got == pytest.approx(val)
    best, parent = {}, {c: p for c, p, _ in rows}
    for c, p, _ in rows:  # parents come first
        taken = p is not None and s[c] >= sum(val[k] for k in kids.get(c, []))
        best[c] = best.get(p) if best.get(p) is not None else c if taken else None
    assert {r.c: r.best for r in hierarchy.chosen(clusters).collect()} == best
    assert parent[0] is None and best[0] is None

