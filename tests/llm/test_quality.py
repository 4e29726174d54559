import zlib

import numpy as np
import pytest

from voxloom.llm import quality as Q
from voxloom.llm.queries import op12_quality

SF = "/root/testdata/sf0.01"


def test_query_on_held_out_documents(spark):
    got = op12_quality(spark, SF)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    assert [t for _, t in got.dtypes] == ["bigint", "boolean", "double", "int"]
    rows = got.collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [(r.predicted, label[r.doc_id]) for r in rows if r.held_out and r.doc_id in label]
    assert np.mean([p == y for p, y in held]) > 0.95
    assert np.mean([p for p, y in held if y == 1]) > 0.98


def test_negative_labels_are_never_read(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    one = Q.with_quality(docs, labels, into="s", steps=30).select("doc_id", "s")
    two = Q.with_quality(docs, labels.where("quality = 1"), into="s", steps=30).select("doc_id", "s")
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))


@pytest.mark.parametrize("share", [0.2, 0.6, 0.9])
def test_prior_of_a_known_mixture(share):
    rng = np.random.default_rng(4)

    def some(n, good):
        out = np.zeros((n, Q.WIDTH))
        out[:, Q.N_CLASSES**2 : -1] = np.clip(rng.normal(np.where(good, 0.7, 0.3)[:, None], 0.1, (n, Q.SHARES)), 0, 1)
        out[:, :5], out[:, -1] = rng.random((n, 5)), 1
        return out

    pos, good = some(2000, np.ones(2000, bool)), rng.random(4000) < share
    unl = some(4000, good)
    prior = Q.estimated_prior(pos, unl)
    assert abs(prior - share) < 0.05
    scorer = Q.fit(pos, unl, prior)
    assert ((scorer.scores(unl) >= 0) == good).mean() > 0.98


def test_risk_is_the_textbook_sum():
    g_pos, g_unl = np.array([2.0, -1.0]), np.array([0.5, -3.0, 1.0])
    loss = lambda z: np.log(1 + np.exp(-z))
    on_pos, on_neg = Q.risk_parts(g_pos, g_unl, 0.4)
    assert on_pos == pytest.approx(0.4 * np.mean([loss(2.0), loss(-1.0)]))
    assert on_neg == pytest.approx(np.mean([loss(-0.5), loss(3.0), loss(-1.0)]) - 0.4 * np.mean([loss(-2.0), loss(1.0)]))


def test_features_cover_whole_texts_in_blocks():
    tail = "a word " * 3000
    assert not np.allclose(Q.features(tail + "x"), Q.features(tail + "!!" * 4000))
    long = "Ab, c.\n" * 10_000
    blocks = [long[k : k + Q.BLOCK] for k in range(0, len(long), Q.BLOCK)]
    expected = sum(Q.block_features(b) * len(b) for b in blocks) / len(long)
    assert np.allclose(Q.features(long), expected)
    assert not Q.features("").any() and not Q.features(None).any()
    assert np.isfinite(Q.features("\n \t")).all() and np.isfinite(Q.features("é")).all()


def test_odd_rows(spark):
    docs = [(1, "Good text here.", 7), (1, "Good text here.", 7), (1, "other", 7), (2, None, 7), (3, "", 7), (None, "BAD!! BAD!!", 7), (4, "BAD!! " * 50_000, 7)]
    docs += [(k, f"Some good words, number {k}. More words.", 7) for k in range(10, 30)]
    table = spark.createDataFrame(docs, "doc_id long, text string, q int")
    labels = spark.createDataFrame([(k, 1, 0) for k in range(10, 20)] + [(1, 1, 0), (1, 0, 0), (2, None, 0), (None, 1, 0), (99, 1, 0)], "doc_id long, quality int, text int")
    rows = Q.with_quality(table, labels, into="s", steps=20).collect()
    assert len(rows) == len(docs) and rows[0].asDict().keys() == {"doc_id", "text", "q", "s"}
    assert all(0 <= r.s <= 1 for r in rows)
    assert len({r.s for r in rows if r.text == "Good text here."}) == 1
    assert {r.s for r in Q.with_quality(table, labels.where("false"), into="s").collect()} == {0.5}
    assert Q.with_quality(table.where("false"), labels, into="s").count() == 0
    with pytest.raises(ValueError):
        Q.with_quality(table, labels, into="q")
