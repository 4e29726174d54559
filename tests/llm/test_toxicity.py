import zlib

import numpy as np

from voxloom.llm.queries import op4_toxicity
from voxloom.llm.toxicity import fit, telling, twins, with_toxicity, words

GROUPS = (("muslim", "christian", "jewish"),)


def logit(model, text):
    weights, bias = model
    return bias + sum(weights.get(w, 0.0) for w in words(text))


def labelled():
    """One group is named mostly in abuse, the other mostly in neutral sentences."""
    rows = [(f"those muslim scum number{i}", 1) for i in range(40)] + [(f"my muslim friend number{i}", 0) for i in range(4)]
    rows += [(f"you scum number{i}", 1) for i in range(10)] + [(f"the christian church number{i}", 0) for i in range(40)]
    return rows + [(f"a quiet evening number{i}", 0) for i in range(40)]


def test_penalty_takes_the_weight_off_identity_terms():
    rows = labelled()
    args = [words(t) for t, _ in rows], [y for _, y in rows]
    gap = lambda m: abs(logit(m, "a muslim neighbour") - logit(m, "a christian neighbour"))
    plain = fit(*args, groups=GROUPS, counterfactual=0.0, min_chi2=4)
    fair = fit(*args, groups=GROUPS, counterfactual=5.0, min_chi2=4)
    assert gap(fair) < 0.5 * gap(plain), (gap(fair), gap(plain))
    assert logit(fair, "a muslim neighbour") < 0 < logit(fair, "muslim scum") and logit(fair, "scum") > 0


def test_twins_swap_every_term():
    assert twins(words("a jewish"), GROUPS) == [words("a muslim"), words("a christian")] and twins({"a"}, GROUPS) == []


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = op4_toxicity(spark, sf)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = {r.doc_id: r for r in got.collect()}
    assert len(rows) == 10_000 and all((zlib.crc32(str(d).encode()) % 3 == 1) == r.held_out for d, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows.values())
    labels = [r for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if rows[r.doc_id].held_out]
    truth = np.array([r.toxic for r in labels])
    said = np.array([rows[r.doc_id].predicted for r in labels])
    assert said[truth == 1].mean() > 0.75 and truth[said == 1].mean() > 0.97


def test_odd_rows_and_no_labels(spark):
    docs = spark.createDataFrame([(1, None, 1), (1, "", 2), (None, "x " * 99999, 3)], "doc_id long, text string, toxic int")
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int")
    rows = with_toxicity(docs, none, "t").collect()
    assert [r.t for r in rows] == [0.5] * 3 and [r.toxic for r in rows] == [1, 2, 3]
    twice = spark.createDataFrame([(1, 1), (1, 0), (1, 1)], "doc_id long, toxic int")
    assert with_toxicity(docs.limit(0), twice, "t").count() == 0 and with_toxicity(docs, twice, "t").count() == 3


def test_telling_words_are_kept_without_a_join(spark, monkeypatch):
    data = [(1, 1, ["bad", "the"]), (2, 1, ["bad", "the"]), (3, 0, ["fine", "the"]), (4, 0, ["muslim", "the"]), (5, 0, [])]
    rows = spark.createDataFrame(data, "row long, toxic int, words array<string>")
    monkeypatch.setattr(type(rows), "join", None)
    assert telling(rows, GROUPS, 3.0) == ([{"bad"}, {"bad"}, set(), {"muslim"}, set()], [1, 1, 0, 0, 0])
