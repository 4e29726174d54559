from collections import defaultdict

import corpus_pipeline as P
import numpy as np

from tests.llm.test_decontamination import brute as contaminated
from tests.llm.test_jaccard_join import brute as components
from tests.llm.test_packing import check
from tests.llm.test_secrets import brute as secret_spans

SF = "/root/testdata/sf0.01"


def test_stages_on_whole_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("score", P.F.lit(1))
    rows = {r.doc_id: r for r in docs.collect()}
    kept = P.written(P.toxicity(spark, docs, SF), "t")
    assert kept.columns == docs.columns
    left = {r.doc_id: r.text for r in kept.collect()}
    toxic = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 1").collect()}
    gone = rows.keys() - left.keys()
    neutral = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 0").collect()}
    assert len(gone & toxic) > 0.6 * len(toxic) and not gone & neutral

    unique = P.written(P.near_duplicates(spark, kept, SF), "u")
    want = {d for d, _, c in components(sorted(left.items()), 5, (80, 100)) if d == c}
    assert unique.columns == docs.columns and sorted(r.doc_id for r in unique.collect()) == sorted(want)

    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    want = {r[0] for r in contaminated([(d, left[d]) for d in want], items) if not r[5]}
    clean = P.written(P.decontamination(spark, unique, SF), "c")
    assert {r.doc_id for r in clean.collect()} == want < {r.doc_id for r in unique.collect()}

    out = P.written(P.secrets(spark, clean, SF), "s")
    assert out.dtypes == docs.dtypes
    final = {r.doc_id: r for r in out.collect()}
    assert final.keys() == want and any("[REDACTED]" in r.text for r in final.values())
    for d, r in final.items():
        assert not secret_spans(r.text) and r.n_chars == len(r.text)
        assert secret_spans(left[d]) or "[REDACTED]" in r.text or r.text == left[d]
    check(P.packing(spark, out, SF).collect(), [(d, r.text) for d, r in final.items()], 4096)


def test_run_and_odd_rows(spark, tmp_path):
    text = " ".join(f"w{i}" for i in range(40))
    given = [(1, text, "en", "a", 1), (1, text, "en", "a", 1), (2, text + " more", "en", "b", 1), (None, None, None, None, None), (3, "", "en", "a", 0), (4, f"token = {'k9' * 9}", "en", "a", 9)]
    folder = str(tmp_path)
    spark.createDataFrame(given, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    rows = P.run(spark, folder).collect()
    tokens = defaultdict(int)
    for r in rows:
        tokens[r.doc_id] += r.length
    assert tokens.keys() == {1, None, 3, 4} and tokens[None] == tokens[3] == 1
    assert np.all([len(r.ids) == 2 * r.length for r in rows])


def test_ids_repeated_with_other_texts(spark):
    text = lambda letter: " ".join(f"{letter}{i}" for i in range(40))
    rows = [
        (7, text("a")), (7, text("a")), (7, text("A")), (7, text("b")), (7, ""), (7, " "), (7, ""), (7, None),  # one of a, b, no words
        (8, text("c")), (5, text("c") + " more"), (8, text("d")),  # only one text of 8 is linked with 5
        (9, text("a") + " more"), (None, text("b")), (None, None), (3, text("e")), (3, text("e") + " more"),
    ]
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id int, text string, lang string").repartition(5)
    out = P.near_duplicates(spark, docs, "")
    assert out.dtypes == docs.dtypes
    got = sorted((r.doc_id or 0, (r.text or "").lower()) for r in out.collect())
    at_3 = [t for d, t in got if d == 3]
    assert len(at_3) == 1 and at_3[0].startswith(text("e"))
    want = [(0, ""), (0, text("b")), (5, text("c") + " more"), (7, ""), (7, ""), (7, ""), (7, " "), (7, text("a")), (7, text("b")), (8, text("d"))]
    assert [g for g in got if g[0] != 3] == sorted(want)
