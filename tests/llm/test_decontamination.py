import hashlib
import re

import pytest

from voxloom.llm.decontamination import with_contamination
from voxloom.llm.queries import op6_decontamination

SF = "/root/testdata/sf0.001"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def brute(docs, items, window=10):
    wins = {}
    for item_id, text in items:
        w = split(text)
        if item_id is not None:
            for i in range(max(1, len(w) - window + 1)) if w else ():
                wins.setdefault(tuple(w[i : i + window]), set()).add(str(item_id))
    out = []
    for doc_id, text in docs:
        w, hit, ids = split(text), set(), set()
        for n in {len(k) for k in wins}:
            for i in range(len(w) - n + 1):
                if (k := tuple(w[i : i + n])) in wins:
                    hit.update(range(i, i + n))
                    ids |= wins[k]
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(ids), digest, bool(hit)))
    return sorted(out, key=str)


def test_query_matches_brute_force_on_whole_tables(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    got = op6_decontamination(spark, SF)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    rows = sorted((tuple(r) for r in got.collect()), key=str)
    assert rows == brute(docs, items) and any(r[5] for r in rows)


DOCS = [
    (1, "x A, b-c! d"), (2, None), (3, ""), (4, "a b c"), (4, "a b c"), (None, "été Éa b c"), (5, "a b a b a b c" * 900),
    (6, "q w e r"), (7, "KK a B c"),
]
ITEMS = [(1, "a B c"), (2, "b c d e"), (3, None), (None, "x a"), (4, "!!"), (11, "a b c"), (5, "e"), (6, "w e"), (6, "w e")]


@pytest.mark.parametrize("block", [1, 5, 10**6])
def test_small_cases_in_one_or_many_blocks(spark, block):
    docs = spark.createDataFrame([(d, t, 0) for d, t in DOCS], "doc_id long, text string, n_words int")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = with_contamination(docs, items, "m", window=3, block_words=block).collect()
    got = sorted(
        (
            (r.doc_id, r.m.n_words, r.m.n_hit, len(r.m["items"]), hashlib.sha256(",".join(r.m["items"]).encode()).hexdigest(), r.m.n_hit > 0)
            for r in rows
        ),
        key=str,
    )
    assert got == brute(DOCS, ITEMS, 3)
    first = next(r for r in rows if r.doc_id == 1)
    assert [first.text[s.start : s.stop] for s in first.m.spans] == ["A, b-c! d"]
    assert first.n_words == 0  # a column of the input that has the same name as a field


def test_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.m.n_hit for r in with_contamination(docs, none, "m").collect()] == [0] * len(DOCS)
    assert with_contamination(docs.limit(0), none, "m").count() == 0
    with pytest.raises(ValueError, match="already"):
        with_contamination(docs, none, "text")
