"""Trap strings for the text rules."""

import pytest
from pyspark.sql import functions as F

from voxloom.functions import text as T
from voxloom.functions import tokens as K
from voxloom.functions.stopwords import ARABIC, ENGLISH, NEGATIONS, stop_words
from voxloom.operators import cleaning as C

CLEANED = [
    ("wow!!?. ok", "wow. ok"),
    ("حلوووو", "حلوو"),
    ("cost 1000", "cost 100"),
    ("ماذا؟؟", "ماذا؟؟"),
    ("see http://a.b/c now", "see now"),
    ("go www.x.y/z?q=1", "go"),
    ("a😀b", "a b"),
    ("a→b ☀️c", "a b c"),
    ("إلى أمة", "الي امه"),
    ("جداً", "جدا"),
    ("ســلام", "سلام"),
    ("a b 　c\x1cd", "a b c d"),
    ("x\n\n\n\ny", "x y"),
    ("  padded\t", "padded"),
    ("a--__b,,", "a_b,"),
    ("😀", ""),
]


def test_clean_text(spark):
    rows = spark.createDataFrame(CLEANED, "text string, want string")
    got = rows.withColumn("got", T.clean_text(F.col("text"))).collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_letters_only_keeps_digits(spark):
    got = spark.createDataFrame([("sooo 1000",)], "t string").select(T.clean_text(F.col("t"), True)).first()[0]
    assert got == "soo 1000"


def test_tokens_and_ngrams(spark):
    rows = spark.createDataFrame([("كلمة، a،b x yy é été² don't _z ١٢",), ("",), ("one",)], "t string")
    held = rows.select(K.tokens(F.col("t")).alias("t"))
    got = held.select("t", K.with_ngrams(F.col("t"), 2).alias("g")).collect()
    assert got[0].t == ["كلمة", "a،b", "yy", "été²", "don", "_z", "١٢"]
    assert got[0].g[7:] == ["كلمة a،b", "a،b yy", "yy été²", "été² don", "don _z", "_z ١٢"]
    assert (got[1].t, got[1].g, got[2].g) == ([], [], ["one"])


def test_plain_texts_get_the_same_tokens_without_looking_around(spark):
    texts = ["don't _z x yy", "A1_b,c-d e2e\tF", "", " ", "İK K2 ABC", "été ABC", "a b c"]
    rows = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    general = F.regexp_extract_all(F.lower("t"), F.lit(K.TOKEN_PATTERN), F.lit(0))
    got = rows.select(K.tokens(F.col("t")).alias("t"), general.alias("g"))
    assert K.ASCII_TOKEN_PATTERN in got._jdf.queryExecution().optimizedPlan().toString()
    assert all(r.t == r.g for r in got.collect())


def test_bigrams_jump_over_stop_words_and_repeats_stay(spark):
    rows = spark.createDataFrame([(["bad", "the", "app", "app"],)], "t array<string>")
    kept = rows.select(K.without(F.col("t"), ["the"]).alias("t"))
    assert kept.select(K.with_ngrams(F.col("t"), 2)).first()[0] == ["bad", "app", "app", "bad app", "app app"]


def test_stop_words():
    words = set(stop_words())
    assert len(ARABIC) == 130 and len(ENGLISH) == len(set(ENGLISH)) == 318 and not words & set(NEGATIONS)
    assert {"a", "yourselves", "thick", "sincere", "hasnt"} <= words and not {"theirs", "does", "just", "ought"} & words
    assert {"the", "amoungst", "على", "مش"} <= words
    assert "الي" not in words and "الي" in stop_words(normalize=True)


def test_word_count_preview_and_flags(spark):
    rows = spark.createDataFrame([("",), ("a",), ("a b c",), ("ا" + "x" * 120,)], "t string")
    got = rows.select(T.word_count(F.col("t")), T.has_arabic(F.col("t")), T.preview(F.col("t"))).collect()
    assert [r[0] for r in got] == [0, 1, 3, 1]
    assert [r[1] for r in got] == [False, False, False, True]
    assert got[3][2] == "ا" + "x" * 119 + "…" and got[2][2] == "a b c"


COMMENTS = [None, "", "   ", "😀", "too short", "this is fine", "this is  fine", "This is fine", "one two three four"]


def test_cleaning_counts_and_frequency(spark):
    rows = spark.createDataFrame(list(enumerate(COMMENTS)), "id long, text string")
    stats = C.cleaning_stats(rows, "text", "id").first().asDict()
    assert stats == {
        "n_original": 9, "removed_null": 4, "removed_short": 1, "duplicate_count": 1, "n_after": 4,
    }
    kept = {r.original_row_index: r.frequency for r in C.clean_comments(rows, "text", "id").collect()}
    assert kept == {5: 2, 6: 2, 7: 1, 8: 1}


def test_nothing_left(spark):
    rows = spark.createDataFrame([(1, "no")], "id long, text string")
    with pytest.raises(ValueError):
        C.require_rows(C.cleaning_stats(rows, "text", "id"))


def test_frequent_texts_take_the_broadcast_path(spark, monkeypatch):
    monkeypatch.setattr(C, "HOT_MIN_ROWS", 3)
    monkeypatch.setattr(C, "HOT_KEYS", 1)
    texts = ["a b c"] * 5 + ["d e f"] * 4 + ["g h i"] * 2 + ["j k l"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = C.clean_comments(rows, "text", "id").collect()
    assert sorted(r.frequency for r in got) == sorted(texts.count(t) for t in texts)


def test_cleaning_runs_once_per_row_and_without_python(spark):
    rows = spark.createDataFrame([(1, "a b c")], "id long, text string")
    plan = C.kept_rows(rows, "text", "id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("https?://") == 1
    assert "Python" not in plan
