import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from voxloom.llm.packing import Queue, pack, packed, windows

PATH = public_tokenizers.path("word_bpe_49k.json")


TOKENIZER = Tokenizer.from_file(PATH)


def ids_of(text):
    return np.array(TOKENIZER.encode(text or "", add_special_tokens=False).ids + [2], "<u4")


def check(rows, docs, length):
    """Every id of every document is in exactly one piece and sequences have no gap."""
    sequences = defaultdict(list)
    pieces = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at and n > 0
            at += n
        assert at == length or (at < length and at & (at - 1) == 0)
    want = Counter()
    for doc_id, text in docs:
        want[doc_id] += len(ids_of(text))
    assert {d: sum(p.length for p in ps) for d, ps in pieces.items()} == dict(want)
    by_id = defaultdict(list)
    for doc_id, text in docs:
        by_id[doc_id].append(ids_of(text))
    for doc_id, parts in pieces.items():
        for p in parts:
            ids = next(a for a in by_id[doc_id] if len(a) == p.doc_tokens)
            assert p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes())
    return sequences


@pytest.mark.parametrize("bucket_ids", [300, 1 << 20])
def test_query_rows_on_whole_documents(spark, bucket_ids):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = packed(docs, PATH, length=512, bucket_ids=bucket_ids * 100, with_ids=False).collect()
    check(rows, [(r.doc_id, r.text) for r in docs.collect()], 512)


def test_odd_rows(spark):
    given = [(1, None, "a", 1), (2, "", None, 1), (3, "word " * 500, None, 1), (4, "x y", "b", 1), (4, "x y", "b", 1), (None, "q", "a", 1)]
    docs = spark.createDataFrame(given, "doc_id long, text string, source string, length int")
    rows = packed(docs, PATH, length=64, least=8).collect()
    check(rows, [r[:2] for r in given], 64)
    assert all(r.ids == ids_of(dict((g[0], g[1]) for g in given)[r.doc_id]).astype("<u2")[r.start : r.start + r.length].tobytes() for r in rows)
    assert packed(docs.limit(0), PATH).count() == 0


def test_windows_are_never_padded():
    assert windows(4096 * 2 + 5, 4096) == [4096, 4096, 4, 1] and windows(0, 4096) == []


def test_every_window_is_near_its_targets():
    rng = np.random.default_rng(3)
    queues = [Queue(share, 0.0) for share in (0.6, 0.3, 0.1)]
    for q, n in zip(queues, (600_000, 300_000, 100_000)):
        while n > 0:
            size = min(n, int(rng.integers(1, 3000)))
            q.docs.append((0, np.zeros(size)))
            n -= size
    counts = defaultdict(lambda: [0, 0, 0])
    for _, _, n, window, _, k in pack(queues, 4096, 256):
        counts[window][k] += n
    table = np.array([counts[w] for w in range(1_000_000 // 4096)])
    drift = np.abs(np.cumsum(table, 0) - np.arange(1, len(table) + 1)[:, None] * 4096 * np.array([0.6, 0.3, 0.1]))
    assert drift.max() < 1500  # never more than about a piece behind or ahead, carried across windows


def test_deficits_cross_buckets_and_targets_hold(spark):
    given = [(i, "word " * 20, "abc"[i % 3 if i % 2 else 0]) for i in range(900)]
    docs = spark.createDataFrame(given, "doc_id long, text string, source string")
    rows = packed(docs, PATH, length=128, least=8, bucket_ids=2000, with_ids=False).collect()
    check(rows, [r[:2] for r in given], 128)
    totals = Counter()
    for r in rows:
        totals[r.source] += r.length
    share = {s: n / sum(totals.values()) for s, n in totals.items()}
    done = Counter()
    size = 0
    drift = []
    for sequence in sorted({r.sequence_id for r in rows}):
        for r in (r for r in rows if r.sequence_id == sequence):
            done[r.source] += r.length
            size += r.length
        drift += [abs(done[s] - share[s] * size) for s in share]
    assert max(drift) < 0.12 * size
    rows = packed(docs, PATH, length=128, least=8, targets={"b": 1.0}, with_ids=False).collect()
    first = [r for r in rows if r.sequence_id < 3]
    assert {r.source for r in first} == {"b"}
