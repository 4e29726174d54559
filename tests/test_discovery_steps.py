"""The steps of topic discovery do their work once, and with as little of it as the result needs."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from voxloom.functions import tokens as K
from voxloom.operators import hierarchy, spanning
from voxloom.operators.embedding import hashed_tfidf
from voxloom.operators.reduction import reduced
from voxloom.plans.discovery import reduced_by
from voxloom.settings import Settings

SETTINGS = Settings(hash_dims=64)


def plan(df, capsys):
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def test_tokens_are_hashed_once(spark, capsys):
    texts = [(k, f"word{k % 5} another{k % 3} third thing number{k}") for k in range(30)] + [(None, "no id here"), (30, "")]
    comments = spark.createDataFrame(texts, "row_id long, cleaned_text string")
    wide = hashed_tfidf(comments, SETTINGS)
    sparse = hashed_tfidf(comments, SETTINGS, sparse=True)
    for vectors in (wide, sparse):
        said = plan(vectors, capsys)
        assert "FileScan parquet" in said and "regexp_extract_all" not in said
    same = sparse.select("row_id", vector_to_array("vec", "float32").alias("vec"))
    rows = lambda df: sorted(((r.row_id is None, r.row_id, r.vec) for r in df.collect()), key=str)
    assert rows(wide) == rows(same) and len(rows(wide)) == 32


def test_reduction_of_sparse_vectors(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 12)) * (rng.uniform(size=(300, 12)) < 0.3)
    x[7] = 0
    x = np.vstack([x, x[:50], x[7:8]])
    rows = spark.createDataFrame([(k, [float(a) for a in v]) for k, v in enumerate(x)], "row_id long, vec array<double>").repartition(5)
    dense = rows.select("row_id", array_to_vector("vec").alias("vec"))
    mixed = VectorAssembler(inputCols=["vec"], outputCol="v").transform(dense).select("row_id", F.col("v").alias("vec"))
    kinds = {r.vec.__class__.__name__ for r in mixed.collect()}
    assert kinds == {"SparseVector", "DenseVector"}
    centred = x - x.mean(0)
    wanted = np.abs(centred @ np.linalg.svd(centred, full_matrices=False)[2][:5].T)
    for given in (rows, dense, mixed):
        got = np.array([r.vec for r in reduced(given, len(x), SETTINGS).orderBy("row_id").collect()])
        assert np.allclose(np.abs(got), wanted, atol=1e-9)
        assert (got[300:350] == got[:50]).all() and (got[350] == got[7]).all()
    assert reduced_by(mixed, len(x), 10, SETTINGS).count() == len(x)


def test_one_vector_has_no_components(spark):
    with pytest.raises(ValueError):
        reduced(spark.createDataFrame([(1, Vectors.sparse(3, {0: 1.0}))], ["row_id", "vec"]), 1, SETTINGS)


def test_points_are_searched_again_only_if_they_matter(monkeypatch):
    """Compared pairs of a cell: later rounds of the tree skip points whose lightest exit is known to be too heavy."""
    monkeypatch.setattr(spanning, "LEAF", 48)
    pairs, plain = [0], spanning.distances
    monkeypatch.setattr(spanning, "distances", lambda a, b: pairs.__setitem__(0, pairs[0] + len(a) * len(b)) or plain(a, b))
    x = np.random.default_rng(2).uniform(size=(4000, 3))
    d = np.sqrt(((x[:, None] - x[None, :400]) ** 2).sum(-1)).T
    leaves = spanning.Leaves(x)
    near, weight = spanning.nearest_weights(leaves, np.full(len(x), np.inf), leaves, np.ones(len(x), np.int64), 8)
    assert np.allclose(near[:400], np.sort(d, axis=1)[:, :8]) and (weight == 1).all()
    core, pairs[0] = near[:, -1], 0
    a, b, w, comp = spanning.inner_tree(x, core, np.full(len(x), np.inf))
    assert (comp == 0).all() and len(a) >= len(x) - 1
    assert pairs[0] < 6_000_000  # 8,992,915 when every point was searched in every round, 3,843,873 since


def test_choice_in_one_task_equals_rounds(spark, monkeypatch):
    rng = np.random.default_rng(8)
    names = [int(n) for n in rng.choice(1 << 62, 300, replace=False)]
    rows = [(names[k], names[rng.integers(0, k)] if k else None, float(rng.uniform(0, 3) - 0.2)) for k in range(300)]
    clusters = spark.createDataFrame([rows[k] for k in rng.permutation(300)], "c long, parent long, s double")
    once = sorted(tuple(r) for r in hierarchy.chosen(clusters).collect())
    monkeypatch.setattr(hierarchy, "FEW", 0)
    assert once == sorted(tuple(r) for r in hierarchy.chosen(clusters).collect())
    assert len(once) == 300 and len({b for _, b in once}) > 10
    assert hierarchy.chosen(clusters.limit(0)).count() == 0


def test_choice_is_one_short_plan(spark):
    """A deep tree takes as many jobs as a flat one: none for each level."""
    rows = [(k, k - 1 if k else None, float(k % 5)) for k in range(400)]
    clusters = spark.createDataFrame(rows, "c long, parent long, s double")
    context = spark.sparkContext
    context.setJobGroup("choice", "choice")
    hierarchy.chosen(clusters).count()
    jobs = context.statusTracker().getJobIdsForGroup("choice")
    context.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < len(jobs) <= 8


def test_components_that_are_joined_by_key(spark, monkeypatch):
    """Without broadcasts the tree is the same."""
    monkeypatch.setattr(spanning, "CELL", 100)
    x = np.random.default_rng(9).normal(size=(700, 3))
    rows = spark.createDataFrame([(k, 1, [float(a) for a in v]) for k, v in enumerate(x)], "id long, weight long, vec array<double>")
    placed, cells, _ = spanning.dealt(rows, 1)
    points = spanning.core_distances(placed, 4).persist()
    weights = []
    for small in (1 << 17, 0):
        monkeypatch.setattr(spanning, "SMALL", small)
        weights.append(sorted(round(r.w, 12) for r in spanning.spanning_tree(points, cells).select("w").collect()))
    assert 699 <= len(weights[0]) <= 720 and sum(weights[0][-600:]) == pytest.approx(sum(weights[1][-600:]))


def test_tokens_without_looking_around(spark):
    texts = [
        "Größe naïve_été 12 a bé Ünïcode--süß", "İstanbul ﬁne ²³ x² ½cup ß", "Ελλάδα и мир 北京 한국어 x", "é éé cafés",
        "مرحبا hello ،؛ ٣٤ كلمة", "\U0001d400\U0001d401 ab\U0001d402 x", "a_ _ __ é_", "–é– “zitat” l’été",
    ]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    careful = F.regexp_extract_all(F.lower("t"), F.lit(K.TOKEN_PATTERN), F.lit(0))
    for row in rows.select("t", K.tokens(F.col("t")).alias("got"), careful.alias("wanted")).collect():
        assert row.got == row.wanted, row.t
    assert str(K.tokens(F.col("t"))).count("regexp_extract_all") == 3  # one of them without looking around
