"""Answers, the staged analysis, lookups and parameters."""

import json

import pytest
from pyspark.sql import functions as F

from voxloom.functions import analysis_texts as X
from voxloom.functions import answers as A
from voxloom.functions import params as P
from voxloom.operators.lookup import attach
from voxloom.plans import analysis as AN
from voxloom.settings import Settings
from voxloom.sources import state

SETTINGS = Settings()
GOOD = {
    "business_name": "بطء التطبيق المتكرر",
    "description": "d",
    "root_cause": "r",
    "severity": "عالية",
    "sentiment": "سلبي",
    "recommended_actions": ["a", "b", "c"],
}


def text(**changes):
    return json.dumps({**GOOD, **changes}, ensure_ascii=False)


ALL_MISSING = [X.MISSING_KEY + k for k in X.REQUIRED_KEYS] + [X.BAD_SEVERITY, X.BAD_SENTIMENT, X.BAD_ACTIONS, X.BAD_NAME]
CASES = [
    (text(), []),
    ("<think>{x}</think>" + text(), []),
    ("Sure!\n" + text() + "\nbye", []),
    (text(recommended_actions=["a", " ", "b", " c "]), []),
    (text(extra={"k": [1]}), []),
    ("nothing", ALL_MISSING),
    ('{"business_name": "x', ALL_MISSING),
    (None, ALL_MISSING),
    (text(recommended_actions=["a", "b"]), [X.BAD_ACTIONS]),
    (text(recommended_actions="one"), [X.BAD_ACTIONS]),
    (text(recommended_actions='["a","b","c"]'), [X.BAD_ACTIONS]),
    (text(recommended_actions=["a", None, "c"]), []),
    (text(business_name="خدمة العملاء"), [X.BAD_NAME]),
    (text(business_name="واحد"), [X.BAD_NAME]),
    (text(business_name="a b c d e"), [X.BAD_NAME]),
    (text(business_name=" a \t b "), []),
    (text(severity="high"), [X.BAD_SEVERITY]),
    (text(severity=None), [X.BAD_SEVERITY]),
    (text(sentiment=" محايد "), []),
]


def test_contract(spark):
    rows = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(CASES)], "i int, answer string")
    got = AN.checked(rows).orderBy("i").collect()
    assert [r.errors for r in got] == [want for _, want in CASES]
    assert got[3].actions == ["a", "b", "c"] and got[11].actions == ["a", "None", "c"]


def test_fallback_names(spark):
    rows = [([], "موضوع غير محدد"), (["app"], "app للعملاء"), (["a b", "b c", "d", "e", "f"], "a b c")]
    df = spark.createDataFrame(rows, "k array<string>, want string")
    assert all(r.got == r.want for r in df.withColumn("got", A.fallback_name(F.col("k"))).collect())


def payloads(spark):
    rows = [(t, [f"word{t}", "app"], f"prompt {t}") for t in range(4)]
    return spark.createDataFrame(rows, "topic_id int, keywords array<string>, prompt string")


def test_staged_answers_retry_and_fallback(spark):
    named = {t: text(business_name=f"name for {t}") for t in "01"}
    refused, mark = text(severity="?"), X.RETRY_HEAD.strip()

    def chat(prompts):
        (prompt,) = prompts
        topic = prompt.split()[1]
        if topic == "0" or (topic == "1" and mark in prompt):
            return [named[topic]]
        if topic == "2":
            raise RuntimeError("model down")
        return [refused]

    stages = []
    got = AN.analysed(payloads(spark), AN.answers_from_model(chat, 2), SETTINGS, on_stage=lambda r: stages.append(r.count()))
    rows = {r.topic_id: r for r in got.collect()}
    assert [rows[t].source for t in range(4)] == ["llm", "llm_retry", "fallback", "fallback"]
    assert stages == [1, 1, 2]
    assert rows[1].business_name == "name for 1" and rows[3].business_name == "word3 app"
    assert rows[2].recommended_actions == list(X.FALLBACK_ACTIONS)


def test_resume_asks_only_what_is_open(spark):
    done = AN.fallback_output(payloads(spark).filter("topic_id = 0")).withColumn("source", F.lit("stored"))
    table = payloads(spark).filter("topic_id <> 0").select("topic_id", F.lit(0).alias("attempt"), F.lit(text()).alias("answer"))
    seen = []

    def answer(prompts):
        seen.extend(r.topic_id for r in prompts.collect())
        return AN.answers_from_table(table)(prompts)

    rows = {r.topic_id: r.source for r in AN.resumed(payloads(spark), done, answer, SETTINGS).collect()}
    assert rows == {0: "stored", 1: "llm", 2: "llm", 3: "llm"} and sorted(seen) == [1, 2, 3]


def test_a_crash_loses_one_batch_at_most(spark, tmp_path):
    rows = payloads(spark)
    table = rows.select("topic_id", F.lit(0).alias("attempt"), F.lit(text()).alias("answer"))
    calls, settings = [], Settings(analysis_batch=2)

    def answer(prompts, dies_at):
        calls.append(sorted(r.topic_id for r in prompts.collect()))
        if len(calls) == dies_at:
            raise RuntimeError("the machine went away")
        return AN.answers_from_table(table)(prompts)

    keep = lambda out: state.append_outputs(out, str(tmp_path), "s")
    with pytest.raises(RuntimeError, match="went away"):
        AN.analysed_in_batches(rows, None, lambda p: answer(p, 3), settings, keep)
    done = state.finished_outputs(spark, str(tmp_path), "s")
    assert {r.topic_id for r in done.collect()} == {0, 1}
    AN.analysed_in_batches(rows, done.cache(), lambda p: answer(p, 0), settings, keep)
    outputs = state.finished_outputs(spark, str(tmp_path), "s").collect()
    assert sorted(r.topic_id for r in outputs) == [0, 1, 2, 3] and not any(0 in c or 1 in c for c in calls[3:])


def test_retry_prompt(spark):
    df = spark.createDataFrame([("p", ["e1", "e2"])], "p string, e array<string>")
    got = df.select(AN.retry_prompt(F.col("p"), F.col("e"))).first()[0]
    assert got == "p" + X.RETRY_HEAD + "e1؛ e2" + X.RETRY_TAIL


def test_executive_failure_is_reported(spark):
    topics = spark.createDataFrame(
        [(0, "n", 5, ["a", "b"], None), (-1, "noise", 2, [], None)],
        "topic_id int, topic_name string, topic_size long, keywords array<string>, description string",
    )
    assert "- n (عدد=5): a، b" in AN.executive_prompt(topics).first()["prompt"]

    def chat(prompts):
        raise RuntimeError("down")

    assert AN.executive_report(topics, chat) == "(executive report unavailable: down)"


PARAMS = [  # n, neighbors, min cluster size, min samples, fallback k
    (149, 10, 5, 2, 10),
    (150, 15, 5, 2, 10),
    (499, 15, 5, 2, 10),
    (500, 20, 10, 4, 10),
    (2999, 20, 29, 4, 11),
    (3000, 40, 30, 8, 12),
    (10000, 40, 50, 8, 40),
    (30000, 40, 100, 8, 50),
]


def test_size_params(spark):
    df = spark.createDataFrame([(p[0],) for p in PARAMS], "n long")
    got = df.select(P.size_params(F.col("n"), SETTINGS).alias("p"), P.fallback_k(F.col("n")).alias("k")).collect()
    assert [(r.p.n, r.p.neighbors, r.p.min_cluster_size, r.p.min_samples, r.k) for r in got] == PARAMS
    manual = df.select(P.size_params(F.col("n"), Settings(auto_params=False)).alias("p")).first()["p"]
    assert (manual.neighbors, manual.min_cluster_size, manual.min_samples, manual.tier) == (30, 50, None, "manual")


@pytest.mark.parametrize("n, rate, want", [(999, 0.9, False), (1000, 0.3, False), (1000, 0.31, True)])
def test_fallback_decision(spark, n, rate, want):
    df = spark.createDataFrame([(n, rate)], "n long, rate double")
    assert df.select(P.needs_fallback(F.col("n"), F.col("rate"), SETTINGS)).first()[0] is want


def test_lookup_beyond_the_broadcast_limit(spark):
    big = spark.range(1000).select(F.col("id").alias("row_id"), (F.col("id") % 3).alias("k"))
    small = spark.createDataFrame([(0, "a"), (1, "b")], "k long, v string")
    usual = attach(big, small, "k", spread_by="row_id", settings=SETTINGS)
    salted = attach(big, small, "k", spread_by="row_id", settings=Settings(broadcast_bytes=0, lookup_salts=8))
    assert sorted(usual.collect()) == sorted(salted.collect())
    assert "BroadcastHashJoin" in usual._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in salted._jdf.queryExecution().executedPlan().toString()
