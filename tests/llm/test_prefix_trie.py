import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from voxloom.llm import prefix_trie
from voxloom.llm.prefix_trie import subtree_sums, trie
from voxloom.llm.queries import op11_prefix_trie

SF = "/root/testdata/sf0.01"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def order(row):
    turn, role, text = row
    return (turn is not None, turn or 0, role, hashlib.sha256(f"{len(role.encode())}:{role}:{text}".encode()).digest())


def brute(rows, heads=9, every=5):
    original = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            original[conv].append((turn, role or "", text or ""))
    original = {c: [(r, t) for _, r, t in sorted(found, key=order)] for c, found in original.items()}
    members = defaultdict(list)
    for c, own in original.items():
        h = zlib.crc32(str(c).encode()) % heads
        base = c - int(np.fmod(c, every))
        turns = original.get(base, [])[:h] + own[h:]
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append((c, len(turns) == d))
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
        leaves[node] = sum(leaves[k] for k in kids[node]) if kids[node] else 1
        saved[node] = own + sum(saved[k] for k in kids[node])
    out = []
    for node, found in members.items():
        ends = hashlib.sha256(",".join(str(c) for c in sorted(c for c, end in found if end)).encode()).hexdigest()
        parent = min(c for c, _ in members[node[:-1]]) if node else None
        out.append((min(c for c, _ in found), len(node), parent, len(found), len(kids[node]), leaves[node], saved[node], ends))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(map(tuple, df.select(COLUMNS).collect()), key=str)


def test_query_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = op11_prefix_trie(spark, SF)
    assert got.columns == COLUMNS and [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"]
    assert rows_of(got) == brute(rows)


def odd_conversations(seed):
    rng = random.Random(seed)
    words = ["", "a", "b", "é", "long text", None]
    rows = []
    for c in [*range(-12, 40), 2**40, 2**40 + 1]:
        if c % 7 != 3:
            n = rng.choice([1, 1, 2, 3, 5, 9, 12])
            rows += [(c, rng.choice([None, k, k, 0]), rng.choice(["user", "user", None, ""]), rng.choice(words[: rng.choice([2, 6])])) for k in range(n)]
    rows += [(50, k, "user", "a") for k in range(300)] + [(51, k, "user", "a") for k in range(290)] + [(55, k, "user", "a") for k in range(300)]
    rows += [(c, k, "user", "a") for c in range(60, 160) for k in range(rng.choice([3, 12, 12, 64, 65, 128]))]
    rows += rows[5:9] + [(None, 1, "user", "lost"), (900, None, None, None)]
    return rows


@pytest.mark.parametrize("most,chunk,seed", [(4096, 64, 1), (3, 4, 2), (1, 64, 3)])
def test_odd_rows_long_chains_and_small_components(spark, monkeypatch, most, chunk, seed):
    monkeypatch.setattr(prefix_trie, "CHUNK", chunk)
    monkeypatch.setattr(prefix_trie, "SMALL", 1)
    monkeypatch.setattr(prefix_trie, "RUN", 50)
    rows = odd_conversations(seed)
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, name string, d int")
    got = rows_of(trie(table.repartition(5), most=most))
    assert got == brute(rows)


def test_empty_table(spark):
    assert trie(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


@pytest.mark.parametrize("shape", ["path", "star", "random", "caterpillar"])
def test_subtree_sums(monkeypatch, shape):
    monkeypatch.setattr(prefix_trie, "SMALL", 1)
    rng, n = np.random.default_rng(7), 500
    up = {"path": np.arange(n) - 1, "star": np.zeros(n, int), "random": np.array([0] + [rng.integers(0, k) for k in range(1, n)])}.get(shape)
    if up is None:
        up = np.array([-1] + [2 * ((k - 1) // 2) for k in range(1, n)])
    up[0] = -1
    depth = np.zeros(n, int)
    for k in range(1, n):
        depth[k] = depth[up[k]] + 1
    own, ends = rng.integers(0, 100, (n, 2)), np.ones(n, int)
    sums, weight = own.copy(), ends.copy()
    for k in range(n - 1, 0, -1):
        sums[up[k]] += sums[k]
        weight[up[k]] += weight[k]
    mixed = rng.permutation(n)
    place = np.argsort(mixed)
    got = subtree_sums(np.where(up[mixed] >= 0, place[up[mixed]], -1), depth[mixed], weight[mixed], own[mixed], np.zeros(n, int))
    assert (got == sums[mixed]).all()
