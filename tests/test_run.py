"""Whole runs on a small comment table, and a sample of the SQL checks."""

import pytest
from pyspark.sql import functions as F

from conformance import check
from voxloom.operators import keywords as KW
from voxloom.operators import metrics as M
from voxloom.operators import representatives as R
from voxloom.operators.arrays import centroids
from voxloom.plans import reports as RP
from voxloom.plans.run import prepare, run_all
from voxloom.settings import Settings

SF = "/root/testdata/sf0.001"
SUBJECTS = {
    "app": "the app is slow and it freezes after every update {}",
    "delivery": "delivery arrived late and the driver never called number {}",
    "دفع": "فشل الدفع بالبطاقة عند اتمام الطلب رقم {}",
}


def comment_table(spark):
    rows = [(i, list(SUBJECTS.values())[i % 3].format(i // 6)) for i in range(240)]
    return spark.createDataFrame(rows, "id long, customer_feedback string")


def test_run_from_table_and_again(spark, tmp_path):
    def chat(prompts):
        return ['{"business_name":"theme of comments","description":"d","root_cause":"r","severity":"عالية",'
                '"sentiment":"سلبي","recommended_actions":["a","b","c"]}']

    run = run_all(comment_table(spark), str(tmp_path), Settings(hash_dims=64), row_col="id", chat=chat)
    labels = {r.row_id: r.topic_id for r in run.comments.collect()}
    assert len(labels) == 240
    by_subject = [{labels[i] for i in range(s, 240, 3)} - {-1} for s in range(3)]
    assert all(a.isdisjoint(b) for n, a in enumerate(by_subject) for b in by_subject[n + 1 :])
    assert run.topics.agg(F.sum("topic_size")).first()[0] == 240
    read = lambda name: spark.read.parquet(f"{tmp_path}/reports/{name}")
    assert read("feedback_with_topics").count() == 240
    summary = read("topic_summary").collect()
    assert {r.business_name for r in summary} == {"theme of comments"}
    assert {r.metric for r in read("overview").collect()} >= {"total_rows", "largest_topics"}
    assert read("settings").count() == 21 and read("quality_check").count() == len(summary)
    assert spark.read.json(f"{tmp_path}/reports/model_outputs").count() == len(summary)
    again = run_all(comment_table(spark), str(tmp_path), Settings(hash_dims=64), row_col="id")
    assert again.signature == run.signature
    assert {r.row_id: r.topic_id for r in again.comments.collect()} == labels


def test_saved_state_follows_what_decides_it(spark, tmp_path):
    table, folder = comment_table(spark), str(tmp_path)
    first = prepare(table, folder, Settings(hash_dims=64), row_col="id")
    wide = prepare(table, folder, Settings(hash_dims=32), row_col="id")
    widths = [r.members.select(F.size("vec")).distinct().collect() for r in (first, wide)]
    assert [[w[0] for w in ws] for ws in widths] == [[64], [32]] and first.signature != wide.signature
    same = prepare(table, folder, Settings(hash_dims=64, broadcast_bytes=1, validation_samples=1), row_col="id")
    assert same.signature == first.signature
    prepare(table.where("id < 200"), folder, Settings(hash_dims=64), row_col="id")
    assert first.comments.count() == 240  # an earlier result outlives later runs


def test_supplied_vectors(spark, tmp_path):
    table = comment_table(spark)
    vectors = table.where("id < 230").select(
        F.col("id").alias("row_id"),
        F.array(*[(F.col("id") % 3 == k).cast("double") * 5 + F.rand(k) * 0.1 for k in range(3)]).alias("vec"),
    ).cache()
    run = prepare(table, str(tmp_path), Settings(), row_col="id", vectors=vectors)
    lengths = run.members.select(F.round(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x), 4)).distinct().collect()
    assert run.members.count() == 230 and [r[0] for r in lengths] == [1.0]


def test_more_than_64_keywords(spark):
    rows = [(i, 0, " ".join(f"kw{k:02d}" for k in range(70) if (k + i) % 2)) for i in range(6)]
    texts = spark.createDataFrame([(i, t, s) for i, t, s in rows], "row_id long, topic_id int, cleaned_text string")
    words = spark.createDataFrame([(0, k + 1, f"kw{k:02d}") for k in range(70)], "topic_id int, rank int, term string")
    got = {(r.rank_i, r.rank_j): r.npmi for r in M.npmi_pairs(texts, words, Settings(top_keywords=70)).collect()}
    assert len(got) == 70 * 69 // 2 and got[(1, 70)] == -1 and got[(1, 69)] == pytest.approx(1.0)


def given(spark):
    rows = [(0, 0, "good fast app"), (1, 0, "fast app again"), (2, 1, "late late parcel"), (3, 1, "parcel again late"),
            (4, -1, "fast parcel again"), (5, 2, "zzz yyy xxx")]
    return spark.createDataFrame([(i, t, s, s, 1) for i, t, s in rows],
                                 "row_id long, topic_id int, original_comment string, cleaned_text string, frequency long")


def test_topic_without_frequent_terms(spark):
    topics = {r.topic_id: r for r in KW.topic_table(given(spark), Settings()).collect()}
    assert topics[2].keywords == [] and topics[2].auto_name == "topic_unknown"
    assert topics[-1].auto_name is None and topics[0].topic_size == 2
    assert "fast app" in topics[0].keywords and set(topics[1].keywords) == {"late", "parcel"}
    names = {r.topic_id: r.topic_name for r in RP.described_topics(KW.topic_table(given(spark), Settings())).collect()}
    assert names[-1] == "noise" and names[2] == "topic_unknown"


def test_perfect_and_missing_cooccurrence(spark):
    words = spark.createDataFrame([(0, 1, "aa"), (0, 2, "bb"), (0, 3, "cc"), (0, 4, "zz"), (1, 1, "aa")],
                                  "topic_id int, rank int, term string")
    texts = spark.createDataFrame([(0, "aa bb"), (1, "aa bb"), (2, "cc aa")], "row_id long, cleaned_text string")
    got = {(r.rank_i, r.rank_j): r.npmi for r in M.npmi_pairs(texts, words, Settings()).collect()}
    assert set(got) == {(1, 2), (1, 3), (2, 3)} and got[(2, 3)] == -1
    assert all(-1 <= v <= 1 for v in got.values())
    assert M.npmi_coherence(texts, words.limit(0), Settings()).first()[0] == 0


@pytest.mark.parametrize("sizes, want", [([5, 5], 1.0), ([1, 3], 0.75), ([], 0.0), ([2, 2, 8], 1 - (2 * (2 + 4 + 24) / 36 - 4 / 3))])
def test_balance(spark, sizes, want):
    rows = spark.createDataFrame([*enumerate(sizes), (-1, 9)], "topic_id int, topic_size long")
    assert M.topic_balance(rows).first()[0] == pytest.approx(want)


def test_plans_keep_comments_in_the_jvm_and_never_pair_them(spark):
    rows = given(spark).withColumn("vec", F.array(F.lit(1.0), F.col("row_id").cast("double")))
    plans = [KW.ctfidf(rows, Settings()), R.representatives(rows, Settings(), 3), centroids(rows)]
    for df in plans:
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "Python" not in plan
    ranked = plans[0]._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in ranked  # the best terms are cut per task, before they move


@pytest.mark.parametrize(
    "name", ["clean_arabic_script", "ctfidf_top10", "representatives_mix", "npmi_pairs", "quality_check", "naming_staged"]
)
def test_equal_to_sql(spark, name):
    assert check.compare(spark, check.connect(SF), SF, name) == ""
