import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from voxloom.llm import suffix_dedup
from voxloom.llm.queries import op2_suffix_dedup
from voxloom.llm.suffix_dedup import deduplicated, least_of

SF = "/root/testdata/sf0.001"


def brute(docs, threshold):
    data = [(t or "").encode() for _, t in docs]
    seen = Counter(d[i : i + threshold] for d in data for i in range(len(d) - threshold + 1))
    out = []
    for (doc_id, _), d in zip(docs, data):
        cover = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - threshold + 1):
            if seen[d[i : i + threshold]] > 1:
                cover[i : i + threshold] = True
        n_spans = int((np.diff(cover.astype(int), prepend=0) == 1).sum())
        kept = bytes(b for b, c in zip(d, cover) if not c)
        out.append((doc_id, len(d), int(cover.sum()), n_spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=str)


def test_query_matches_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = op2_suffix_dedup(spark, SF)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    rows = rows_of(got)
    assert rows == brute(docs, 400) and any(r[2] for r in rows)


@pytest.mark.parametrize("threshold,seed", [(12, 1), (30, 2), (31, 3)])
def test_overlaps_periods_and_copies(spark, threshold, seed):
    rng = random.Random(seed)
    word = lambda n, letters="abé": "".join(rng.choice(letters) for _ in range(n))
    shared = [word(rng.randrange(5, 90)) for _ in range(8)]
    texts = [None, "", "a" * 200, "a" * (threshold - 1), "ab" * 90, word(threshold), "x" * threshold, "x" * threshold]
    for _ in range(30):
        texts.append("".join(rng.choice([word(rng.randrange(60)), rng.choice(shared)]) for _ in range(rng.randrange(1, 7))))
    texts += [texts[10]] * 3 + [texts[11][:-3]]
    docs = list(enumerate(texts)) + [(3, texts[9]), (None, texts[12])]
    table = spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, key int")
    assert rows_of(deduplicated(table, threshold=threshold)) == brute(docs, threshold)


@pytest.mark.parametrize("threshold", [512, 1024, 2048])
def test_strings_with_equal_sums_modulo_a_power_of_two_stay(spark, threshold):
    even = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))  # even - odd is a product of (1 - x^k)
    odd = even.translate(str.maketrans("ab", "ba"))
    texts = [f"1{even}2", f"3{odd}4", f"5{even}{odd}c", f"6{odd}{even}d", f"7{even}{even}e", f"8{even[:700]}"]
    docs = list(enumerate(texts))
    table = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows_of(deduplicated(table, threshold=threshold)) == brute(docs, threshold)
    alone = spark.createDataFrame([(1, even), (2, odd)], "doc_id long, text string")
    if threshold == 1024:
        assert [r[2] for r in rows_of(deduplicated(alone, threshold=threshold))] == [0, 0]


def test_long_texts_are_named_in_blocks_that_do_not_show(monkeypatch):
    data = bytes(random.Random(5).choices(b"ab", k=3000)) * 2
    whole = suffix_dedup.runs(suffix_dedup.Names(), data, 60)
    monkeypatch.setattr(suffix_dedup, "BLOCK", 97)
    assert all((a == b).all() for a, b in zip(whole, suffix_dedup.runs(suffix_dedup.Names(), data, 60)))


def test_empty_table(spark):
    assert deduplicated(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_least_of_every_width():
    values = np.random.default_rng(0).integers(0, 1000, 50)
    for width in range(1, 50):
        assert least_of(values, width).tolist() == [values[i : i + width].min() for i in range(50 - width + 1)]
