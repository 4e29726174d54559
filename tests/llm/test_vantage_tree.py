import numpy as np
import pytest

from voxloom.llm.queries import op3_vantage_tree
from voxloom.llm.vantage_tree import nearest, usable
from pyspark.sql import functions as F


def brute(rows, is_query, k):
    rows = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v]
    rows = [(i, v) for i, v in rows if np.isfinite(v).all() and v.any()]
    out = {}
    for place, (q, x) in enumerate(rows):
        if is_query(q):
            near = [(float(np.sqrt(((x - y) ** 2).sum())), i) for at, (i, y) in enumerate(rows) if at != place]
            out.setdefault(q, []).append(sorted(near)[:k])
    # One ranking for each row of an id, all of them in one sorted list.
    return {q: sorted(pair for best in lists for pair in best) for q, lists in out.items() if any(lists)}


def test_query_recall_and_exact_scores(spark):
    sf = "/root/testdata/sf0.1"
    got = op3_vantage_tree(spark, sf)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute(rows, lambda i: i % 100 == 0, 10)
    vectors = {i: np.array(v, float) for i, v in rows}
    hits, found = 0, got.collect()
    for r in found:
        hits += r.vec_id in {i for _, i in want[r.query_id]}
        assert abs(r.score - np.sqrt(((vectors[r.query_id] - vectors[r.vec_id]) ** 2).sum())) < 1e-12
    assert len(found) == sum(map(len, want.values())) and hits / len(found) >= 0.95


@pytest.mark.parametrize("shard,block", [(1000, 1000), (37, 5)])
def test_factor_one_is_exact_with_ties_and_odd_rows(spark, shard, block):
    rng = np.random.default_rng(2)
    rows = [(i, rng.integers(-2, 3, 4).astype(float).tolist()) for i in range(300)] + [(1000 + i, [1.0, 1.0, 1.0, 1.0]) for i in range(150)]
    rows += [(500, None), (501, []), (502, [0.0] * 4), (503, [1.0, None, 2.0, 3.0]), (504, [float("nan")] * 4), (505, [float("inf"), 1.0, 1.0, 1.0]), (None, [1.0] * 4), (7, [9.0] * 4)]
    table = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, rank int")
    got = {}
    for r in nearest(table, F.col("vec_id") % 10 == 0, k=5, shard_rows=shard, block_rows=block, leaf=8).orderBy("query_id", "score", "vec_id").collect():
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    want = brute(rows, lambda i: i % 10 == 0, 5)
    assert got.keys() == want.keys()
    for q, best in want.items():
        assert [i for _, i in got[q]] == [i for _, i in best] and np.allclose([d for d, _ in got[q]], [d for d, _ in best])


def test_rows_of_one_id_are_queries_and_candidates_of_their_own(spark):
    rows = [(100, [1.0, 0.0]), (100, [2.0, 0.0]), (1, [0.0, 1.0]), (2, [5.0, 0.0]), (2, [5.0, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = sorted((r.score, r.rank, r.vec_id) for r in nearest(table, F.col("vec_id") == 100).collect() if r.query_id == 100)
    want = []
    for place, (_, x) in enumerate(rows[:2]):
        others = sorted((float(np.hypot(*np.subtract(x, y))), i) for at, (i, y) in enumerate(rows) if at != place)
        want += [(d, rank, i) for rank, (d, i) in enumerate(others, 1)]
    assert found == sorted(want)


def test_few_rows_and_lengths(spark):
    two = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in nearest(two, F.lit(True)).orderBy("query_id").collect()] == [(0, 1, 1, 2**0.5), (1, 1, 0, 2**0.5)]
    assert nearest(two.limit(0), F.lit(True)).count() == 0 and nearest(two.limit(1), F.lit(True)).count() == 0
    assert usable(two).count() == 2
    odd = two.union(spark.createDataFrame([(2, [1.0])], two.schema))
    with pytest.raises(ValueError, match="components"):
        nearest(odd, F.lit(True))
