"""Texts are moved and held only where a query reads them, in partitions that do not grow with the table."""

from pyspark.sql import functions as F

from conformance import queries as Q
from voxloom.operators import lookup
from voxloom.operators import metrics as M
from voxloom.operators import representatives as R
from voxloom.operators.keywords import topic_term_counts, vocabulary
from voxloom.settings import Settings


def tables(spark, folder, n=40):
    ids = spark.range(n)
    texts = ids.select(
        F.col("id").alias("doc_id"), F.concat(F.lit("word number "), F.col("id") % 7, F.lit(" again")).alias("text"),
        F.lit("en").alias("lang"),
    )
    texts.write.parquet(f"{folder}/documents.parquet")
    vectors = ids.filter("id % 2 = 0").select(F.col("id").alias("vec_id"), (F.col("id") % 3).cast("int").alias("label"))
    vectors.withColumn("embedding", F.array(F.lit(1.0), F.col("label").cast("double"))).write.parquet(f"{folder}/embeddings.parquet")
    return str(folder)


def test_sizes_neither_hold_nor_move_texts(spark, tmp_path):
    sf = tables(spark, tmp_path)
    sizes = Q.topic_sizes(spark, sf)
    plan = sizes._jdf.queryExecution().optimizedPlan().toString()
    assert "InMemoryRelation" not in plan
    assert {r.topic_id: r.topic_size for r in sizes.collect()} == {-1: 20, 0: 7, 1: 6, 2: 7}


def test_texts_are_dealt_by_their_bytes(spark, monkeypatch):
    monkeypatch.setattr(lookup, "TEXT_BYTES", 100)
    texts = spark.range(200).select(F.col("id").alias("row_id"), F.lit("blue letters").alias("cleaned_text"))
    labels = spark.range(200).select(F.col("id").alias("row_id"), (F.col("id") % 2).cast("int").alias("topic_id"))
    joined = lookup.labelled_texts(texts, labels)
    assert joined.rdd.getNumPartitions() == 24  # 2,400 bytes
    got = {(r.topic_id, r.term): (r.cnt, r.docs) for r in topic_term_counts(joined, Settings()).collect()}
    assert got == {(t, w): (100, 100) for t in (0, 1) for w in ("blue", "letters", "blue letters")}


def test_counted_grams_move_once_and_by_term(spark, monkeypatch):
    monkeypatch.setattr(lookup, "TEXT_BYTES", 100)
    texts = spark.range(200).select(F.col("id").alias("row_id"), F.lit("blue letters").alias("cleaned_text"))
    labels = spark.range(200).select(F.col("id").alias("row_id"), (F.col("id") % 2).cast("int").alias("topic_id"))
    counts = topic_term_counts(lookup.labelled_texts(texts, labels), Settings())
    per_term = vocabulary(counts, Settings())
    plan = per_term._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(term") == 1 and "Exchange hashpartitioning(topic_id" not in plan
    assert "hashpartitioning(term" in plan and ", 24)" in plan  # as many partitions as deals
    got = {(r.topic_id, r.term): (r.cnt, r.docs, r.doc_freq) for r in per_term.collect()}
    assert got == {(t, w): (100, 100, 200) for t in (0, 1) for w in ("blue", "letters", "blue letters")}


def test_only_chosen_originals_are_joined(spark, tmp_path):
    sf = tables(spark, tmp_path)
    rows = Q.kept_once(spark, sf)
    asked = []

    def narrowed(ids):
        asked.append(sorted(r.row_id for r in ids.collect()))
        return Q.narrowed_members(spark, sf, rows)(ids)

    members = Q.members(spark, sf, rows)
    plain = R.representatives(members, Settings(), 1).sort("topic_id").collect()
    assert R.representatives(members, Settings(), 1, narrowed=narrowed).sort("topic_id").collect() == plain
    assert asked == [sorted(r.row_id for r in plain)] and len(plain) == 3


def test_texts_read_several_times_are_written(spark, tmp_path):
    sf = tables(spark, tmp_path)
    rows = Q.kept_once(spark, sf)
    assert "InMemoryRelation" not in rows._jdf.queryExecution().optimizedPlan().toString()
    assert rows.inputFiles() and rows.count() == 40


def test_counting_writes_no_originals(spark, tmp_path, monkeypatch):
    sf, written = tables(spark, tmp_path), []
    monkeypatch.setattr(Q, "stored", lambda df, name: written.append(df.columns) or df)
    Q.topics(spark, sf), Q.counted_texts(spark, sf), Q.keyword_document_frequency(spark, sf), Q.run_metrics(spark, sf)
    assert written == [["row_id", "cleaned_text"]] * 4


def test_keyword_sets_are_found_without_moving_texts(spark, tmp_path):
    sf = tables(spark, tmp_path)
    rows = Q.kept_texts(spark, sf)
    words = spark.createDataFrame([(0, 1, "word"), (1, 2, "again")], "topic_id int, rank int, term string")
    sets = M.keyword_sets(Q.own_texts(rows), words, Settings())
    assert "embeddings" not in "".join(sets.inputFiles())
    assert sorted(sets.collect()) == sorted(M.keyword_sets(Q.topic_texts(spark, sf, rows), words, Settings()).collect())
    plain = M.npmi_pairs(Q.topic_texts(spark, sf, rows), words, Settings()).collect()
    assert M.npmi_pairs(Q.topic_texts(spark, sf, rows), words, Settings(), Q.own_texts(rows)).collect() == plain


def test_representatives_move_a_digest_of_the_text(spark, tmp_path):
    sf = tables(spark, tmp_path)
    rows = Q.kept_once(spark, sf)
    found = R.candidates(Q.members(spark, sf, R.keyed(rows)), Settings(), 2)
    joins = found._jdf.queryExecution().optimizedPlan().toString().split("Join Inner")
    assert len(joins) > 1 and "cleaned_text" not in joins[0] and "sha2" not in joins[0]
    assert sorted(found.collect()) == sorted(R.candidates(Q.members(spark, sf, rows), Settings(), 2).collect())
