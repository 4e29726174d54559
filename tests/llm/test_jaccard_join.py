import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from voxloom.llm.components import components
from voxloom.llm.jaccard_join import exact_set, jaccard_components, overlap_bound, shared, words_of
from voxloom.llm.queries import op10_jaccard_join

SF = "/root/testdata/sf0.01"


def shingles(text, size):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    width = min(size, len(words))
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if width else set()


def brute(docs, size, share):
    sets = [(d, shingles(t, size)) for d, t in docs]
    root = {d: d for d, _ in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and share[0] * max(len(x), len(y)) <= share[1] * min(len(x), len(y)):
                inter = len(x & y)
                if share[1] * inter >= share[0] * (len(x) + len(y) - inter):
                    lo, hi = sorted((find(a), find(b)))
                    root[hi] = lo
    return sorted((d, len(s), find(d)) for d, s in sets)


def test_query_matches_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = op10_jaccard_join(spark, SF)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    rows = sorted(tuple(r) for r in got.collect())
    assert rows == brute(docs, 3, (90, 100)) and any(a != c for a, _, c in rows)


@pytest.mark.parametrize("size,share,seed", [(3, (90, 100), 1), (5, (8, 10), 2), (2, (1, 2), 3)])
def test_chains_of_near_copies_and_odd_rows(spark, size, share, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    docs = [(i, rng.choice([None, "", " \t\n", "one", "two words", "Two\x0bWORDS", "a b c"])) for i in range(20)]
    for base in range(4):
        text = [rng.choice(words) for _ in range(60)]
        for _ in range(25):
            if rng.random() < 0.3:
                text = text[: rng.randrange(5, 60)] + [rng.choice(words) for _ in range(3)] + text[30:]
            changed = list(text)
            for _ in range(rng.randrange(3)):
                changed[rng.randrange(len(changed))] = rng.choice(words)
            docs.append((len(docs), rng.choice([" ", "  "]).join(changed)))
    rng.shuffle(docs)
    table = spark.createDataFrame([(d, t, 0, 0) for d, t in docs], "doc_id long, text string, n int, component_id long")
    assert sorted(tuple(r) for r in jaccard_components(table, size=size, share=share).collect()) == brute(docs, size, share)


def test_empty_table_repeated_and_missing_ids(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (2, "A B c d"), (None, None)], "doc_id long, text string")
    rows = jaccard_components(docs).collect()
    assert sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in rows) == [(0, 0, 0), (0, 2, 1), (1, 2, 1), (1, 2, 1), (2, 2, 1)]
    assert jaccard_components(docs.limit(0)).count() == 0


def test_rows_of_one_id_join_the_links_of_each(spark):
    x, y = "a b c d e", "v w x y z"
    docs = [(3, x), (7, x), (7, y), (9, y), (11, "p q r"), (12, "s t u"), (12, "p q r"), (13, "s t u v")]
    rows = jaccard_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.component_id) for r in rows) == [(3, 3), (7, 3), (7, 3), (9, 3), (11, 11), (12, 11), (12, 11), (13, 13)]


def test_words_with_equal_sums_modulo_a_power_of_two_stay_apart(spark):
    even = "".join("ab"[bin(i).count("1") % 2] for i in range(2048))  # even - odd is a product of (1 - x^k)
    odd = even.translate(str.maketrans("ab", "ba"))
    docs = [(1, even), (2, odd), (3, f"{even} {odd} c"), (4, f"{odd} {even} c"), (5, f"{even} d e f"), (6, f"{odd} d e f"), (7, odd.upper())]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    assert sorted(tuple(r) for r in jaccard_components(table).collect()) == brute(docs, 3, (90, 100))


@given(st.lists(st.text(" \taAé\x1c\x85\xa0", max_size=8), min_size=1, max_size=3), st.integers(1, 4))
def test_exact_sets_equal_brute_force(found, size):
    known = {}
    sets = [exact_set(words_of(t), size, known) for t in found]
    want = [shingles(t, size) for t in found]
    assert [len(s) for s in sets] == [len(s) for s in want]
    assert [shared(sets[0], s) for s in sets] == [len(want[0] & s) for s in want]


@settings(max_examples=100, deadline=None)
@given(st.sets(st.integers(0, 60)), st.sets(st.integers(0, 60)))
def test_suffix_bound_is_never_too_low(x, y):
    a, b = np.array(sorted(x), np.int64), np.array(sorted(y), np.int64)
    assert len(x & y) <= overlap_bound(a, b) <= min(len(x), len(y))


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (300, 200)]
    got = {r.id: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 130), 100), 200: 200, 300: 200}
