"""Comment files, sinks and saved state."""

import pytest
from pyspark.sql import functions as F

from voxloom.operators.embedding import encoded
from voxloom.settings import Settings
from voxloom.sources import sinks, state
from voxloom.sources.comments import invalid_files, load_comments, pick_comment_column

HEAD = "id,customer_feedback\n"


def test_csv_with_mark_quotes_and_line_breaks(spark, tmp_path):
    text = '﻿customer_feedback,id\n"one ""two""\nthree",1\nNA,2\nplain,3\n'
    (tmp_path / "a.csv").write_text(text, encoding="utf-8")
    rows = load_comments(spark, str(tmp_path / "a.csv"), row_col="n").orderBy("n").collect()
    assert rows[0].asDict() == {"customer_feedback": 'one "two"\nthree', "id": "1", "n": 0}
    assert [r.customer_feedback for r in rows[1:]] == [None, "plain"]


def test_each_file_in_its_own_encoding(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes((HEAD + "1,خدمة ممتازة\n").encode("utf-8"))
    (tmp_path / "b.csv").write_bytes((HEAD + "2,خدمة سيئة\n").encode("cp1256"))
    assert [f.rsplit("/", 1)[1] for f in invalid_files(spark, str(tmp_path))] == ["b.csv"]
    rows = load_comments(spark, str(tmp_path), row_col="n").orderBy("n").collect()
    assert [(r.n, r.customer_feedback) for r in rows] == [(0, "خدمة ممتازة"), (1, "خدمة سيئة")]


def test_positions_are_dense_over_many_files(spark, tmp_path):
    sizes = [3, 1, 40, 7]
    for f, size in enumerate(sizes):
        lines = "".join(f"{f}-{i},x\n" for i in range(size))
        (tmp_path / f"part{f}.csv").write_text(HEAD + lines)
    rows = load_comments(spark, str(tmp_path), row_col="n").orderBy("n").collect()
    assert [r.n for r in rows] == list(range(sum(sizes)))
    assert [r.id for r in rows] == [f"{f}-{i}" for f, size in enumerate(sizes) for i in range(size)]


def test_source_guards(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_comments(spark, str(tmp_path / "none.csv"))
    with pytest.raises(ValueError):
        load_comments(spark, str(tmp_path / "book.xlsx"))
    with pytest.raises(KeyError, match="id"):
        pick_comment_column(spark.range(1), "text")


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(1, ' "a",\nb '), (2, "ج")], "id long, text string")
    sinks.write_tables({"t": rows}, str(tmp_path), "csv")
    read = spark.read.options(header=True, multiLine=True, escape='"').csv(str(tmp_path / "t"))
    assert sorted(r.text for r in read.collect()) == [' "a",\nb ', "ج"]
    sinks.write_json(rows, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    sinks.write_text(spark, "line one\nline two", str(tmp_path / "s"))
    assert "".join(p.read_text() for p in (tmp_path / "s").glob("*.txt")).strip() == "line one\nline two"


def test_signature(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, text string")
    base = state.signature(rows, "id", "text")
    assert len(base) == 12 and base == state.signature(rows.orderBy(F.desc("id")), "id", "text")
    swapped = rows.withColumn("id", 4 - F.col("id"))
    assert len({base, state.signature(swapped, "id", "text"), state.signature(rows, "id", "text", "k")}) == 3
    assert state.signature(rows.limit(0), "id", "text") != base


def test_vector_cache_is_read_only_when_complete(spark, tmp_path):
    ids = spark.range(4).withColumnRenamed("id", "row_id")
    calls = []

    def make(rows):
        calls.append(1)
        return rows.withColumn("vec", F.array(F.lit(1.0)))

    for rows in (ids, ids, ids.limit(3)):
        assert state.cached_vectors(rows, make, str(tmp_path), "m", "s").count() == rows.count()
    assert len(calls) == 2


def test_checkpoint(spark, tmp_path):
    one = spark.range(1)
    tables = {name: one.withColumn("name", F.lit(name)) for name in state.CHECKPOINT_TABLES}
    assert state.load_result(spark, str(tmp_path), "a") is None
    state.save_result(tables, str(tmp_path), "a")
    assert state.load_result(spark, str(tmp_path), "b") is None
    assert state.load_result(spark, str(tmp_path), "a")["params"].first()["name"] == "params"


def test_encoder_runs_in_batches_with_prefix(spark):
    rows = spark.createDataFrame([(i, "x" * i) for i in range(1, 8)], "row_id long, cleaned_text string")

    def encode(texts):
        assert len(texts) <= 3 and all(t.startswith("query: ") for t in texts)
        return [[float(len(t)), 0.0] for t in texts]

    got = encoded(rows, encode, Settings(embed_batch_size=3)).orderBy("row_id").collect()
    assert [r.row_id for r in got] == list(range(1, 8)) and all(r.vec == [1.0, 0.0] for r in got)
