"""Prefix trie of conversations, rolled up by centroid decomposition.

Conversations that begin with the same turns share the nodes of those turns. A node is named by digests
of its turns: turns are chained in pieces of ``CHUNK``, and the pieces' digests in pieces again, so a very
long conversation is named by many tasks and equal beginnings still get equal names.

Runs of nodes with the same members become one vertex. Subtree sums over the vertices come from centroid
decomposition: in each component of the forest of parent edges the vertices whose subtree holds more than
half of the component's conversations form a path from the top; the lowest of them is the centroid. The
total of the centroid's part is added to every vertex of that path, and the component falls apart into
what is above the centroid and one component below each of its children, none with more than half of the
conversations. So there are as many rounds as the number of conversations has binary digits, however
deep the trie is. Components of at most ``most`` vertices are decomposed inside one task.

Cases: null roles and texts become empty; turns are ordered by turn (null first), ties by role, then by
a digest of the text; repeated rows are turns of their own; rows without conv_id take no part; an empty
table has no node, not even a root; columns other than conv_id, turn, role and text are ignored.
One thing stays in one task by its nature: the SHA-256 of a node's conv_ids, which are streamed in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxloom.llm.common import written

CHUNK = 64  # turns named one after the other
HOT = 10_000  # keys with more than one in HOT of all rows are looked up by broadcast: fewer than HOT keys
RUN = 1 << 16  # nodes of a vertex summed up together
SMALL = 32  # vertices of a component summed up directly
MOST = 4096
COMPONENTS = 200_000  # components split in one round, and so rows broadcast


# ---- conversations -------------------------------------------------------------------------------------
def positioned(turns: DataFrame) -> DataFrame:
    """conv, pos (from 0), digest, bytes: rows in order, numbered without any conversation in one task."""

    def number(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in rows:
            if not batch.num_rows:
                continue
            conv = batch.column(0).to_numpy()
            at = np.arange(len(conv))
            new = np.flatnonzero(np.diff(conv, prepend=conv[0] - 1 if last != conv[0] else conv[0]))
            start = np.zeros(len(conv), np.int64)
            start[new] = new
            start = np.maximum.accumulate(start)
            local = at - start
            if last == conv[0]:
                local[: new[0] if len(new) else None] += seen
            last, seen = conv[-1], int(local[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(len(conv), part), pa.int32()), pa.array(local), batch.column(1), batch.column(2)],
                ["conv", "part", "local", "digest", "bytes"],
            )

    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), "turn", role.alias("role"),
        F.unhex(F.sha2(F.concat_ws(":", F.octet_length(role).cast("string"), role, text), 256)).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"),
        F.monotonically_increasing_id().alias("deal"),
    )
    order = ["conv", F.col("turn").asc_nulls_first(), "role", "digest", "deal"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "digest", "bytes")
    found = written(ordered.mapInArrow(number, "conv long, part int, local long, digest binary, bytes long"), "trie-turns")
    runs = found.groupBy("conv", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # Only the first conversation of a part can have rows in an earlier one: one row per part at most.
    later = runs.withColumn("before", F.sum("n").over(earlier)).where("before is not null").drop("n")
    return found.join(F.broadcast(later), ["conv", "part"], "left").select(
        "conv", (F.col("local") + F.coalesce("before", F.lit(0))).alias("pos"), "digest", "bytes"
    )


def rebuilt(turns: DataFrame, heads: int, every: int) -> tuple[DataFrame, DataFrame]:
    """Turns (conv, d, digest, bytes) after the heads are exchanged, and all conversations (conv, n).

    A conversation starts with the first h turns of the one whose id is the next multiple of ``every``
    towards zero, h being the crc32 of its own id modulo ``heads``, and goes on with its own turns.
    """
    sizes = written(turns.groupBy("conv").agg(F.count("*").alias("n")), "trie-sizes")
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % heads).alias("h")
    ids = sizes.select("conv", h, (F.col("conv") - F.col("conv") % every).alias("base"), F.col("n").alias("own"))
    ids = ids.join(sizes.select(F.col("conv").alias("base"), F.col("n").alias("there")), "base", "left")
    ids = ids.withColumn("taken", F.least(F.coalesce("there", F.lit(0)), "h"))
    first = turns.where(F.col("pos") < heads - 1).select(F.col("conv").alias("base"), "pos", "digest", "bytes")
    head = ids.join(first, "base").where("pos < h").select("conv", (F.col("pos") + 1).alias("d"), "digest", "bytes")
    own = turns.withColumn("h", h).where("pos >= h")
    # Only where the other conversation is missing or too short do turns move up.
    moved = ids.where("taken < h").select("conv", (F.col("h") - F.col("taken")).alias("up"))
    own = looked_up(own, moved, "conv", sizes.select("conv", "n"))
    own = own.select("conv", (F.col("pos") + 1 - F.coalesce("up", F.lit(0))).alias("d"), "digest", "bytes")
    size = (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n")
    return head.unionByName(own), ids.select("conv", size)


def looked_up(rows: DataFrame, table: DataFrame, key: str, counts: DataFrame) -> DataFrame:
    """``rows`` left join ``table`` (unique on ``key``); counts: key, n, the rows of each key.

    Keys in more than one of HOT rows are looked up by broadcast, so no task gets all rows of such a key.
    """
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = F.broadcast(counts.where(F.col("n") > total / HOT).select(key))  # fewer than HOT rows
    often = rows.join(hot, key, "left_semi").join(F.broadcast(table.join(hot, key, "left_semi")), key, "left")
    return often.unionByName(rows.join(hot, key, "left_anti").join(table, key, "left"))


def named(turns: DataFrame) -> DataFrame:
    """conv, d, bytes, name: the name stands for the first d digests of the conversation."""

    def chain(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, name = None, b""
        for batch in rows:
            names = []
            for conv, chunk, digest in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3))):
                if (conv, chunk) != last:
                    last, name = (conv, chunk), b""
                name = hashlib.sha256(name + digest).digest()
                names.append(name)
            arrays = [*(batch.column(k) for k in (0, 1, 2, 4)), pa.array(names, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["conv", "chunk", "d", "bytes", "name"])

    cells = turns.select("conv", F.floor((F.col("d") - 1) / CHUNK).alias("chunk"), "d", "digest", "bytes")
    cells = cells.repartition("conv", "chunk").sortWithinPartitions("conv", "chunk", "d")
    found = written(cells.mapInArrow(chain, "conv long, chunk long, d long, bytes long, name binary"), "trie-chains")
    whole = found.where(F.col("d") % CHUNK == 0)
    if whole.isEmpty():
        return found.drop("chunk")
    above = named(whole.select("conv", (F.col("chunk") + 1).alias("d"), F.col("name").alias("digest"), "bytes"))
    above = above.select("conv", F.col("d").alias("chunk"), F.col("name").alias("above"))
    later = found.where("chunk > 0").join(above, ["conv", "chunk"])
    later = later.withColumn("name", F.unhex(F.sha2(F.concat("above", "name"), 256)))
    return found.where("chunk = 0").drop("chunk").unionByName(later.drop("chunk", "above"))


# ---- nodes ---------------------------------------------------------------------------------------------
def ends_of(rows: DataFrame) -> DataFrame:
    """name, ends_sha256: digest of the ascending conv ids of each name, streamed in order."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None
        for batch in batches:
            out = []
            for name, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if name != last:
                    if state:
                        out.append((last, state.hexdigest()))
                    last, state = name, hashlib.sha256(str(conv).encode())
                else:
                    state.update(b",%d" % conv)
            yield as_rows(out)
        if state:
            yield as_rows([(last, state.hexdigest())])

    def as_rows(out: list) -> pa.RecordBatch:
        names, digests = zip(*out) if out else ((), ())
        return pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(digests, pa.string())], ["name", "ends_sha256"])

    ordered = rows.select("name", "conv").repartition("name").sortWithinPartitions("name", "conv")
    return ordered.mapInArrow(digest, "name binary, ends_sha256 string")


def root_name() -> F.Column:
    return F.lit(b"").alias("name")


def trie(conversations: DataFrame, *, heads: int = 9, every: int = 5, most: int = MOST) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns, convs = rebuilt(positioned(conversations), heads, every)
    convs = written(convs, "trie-conversations")
    members = written(named(turns), "trie-members")
    grouped = members.groupBy("name").agg(F.min("conv").alias("conv"), F.first("d").alias("d"), F.count("*").alias("n"), F.first("bytes").alias("bytes"))
    root = convs.agg(F.min("conv").alias("conv"), F.count("*").alias("n")).where("n > 0")
    nodes = grouped.unionByName(root.select(root_name(), "conv", F.lit(0).cast("long").alias("d"), "n", F.lit(0).cast("long").alias("bytes")))
    nodes = written(nodes, "trie-nodes")
    # A node's parent is the one of its smallest member's turn before, found by keys that occur once.
    before = members.select("conv", (F.col("d") + 1).alias("d"), F.col("name").alias("parent"))
    edges = written(nodes.where("d > 0").join(before, ["conv", "d"], "left").withColumn("parent", F.coalesce("parent", root_name())), "trie-edges")
    children = written(edges.groupBy("parent").agg(F.count("*").alias("n")), "trie-children")
    parents = nodes.select(F.col("name").alias("parent"), F.col("conv").alias("up_conv"), F.col("n").alias("up_n"))
    edges = looked_up(edges, parents, "parent", children)
    kids = children.select(F.col("parent").alias("name"), F.col("n").alias("n_children"))
    full = edges.drop("parent").unionByName(nodes.where("d = 0"), allowMissingColumns=True).join(kids, "name", "left")
    own = ((F.col("n") - 1) * F.col("bytes")).alias("own")
    full = written(full.select("name", "conv", "d", "n", "up_conv", "up_n", F.coalesce("n_children", F.lit(0)).alias("n_children"), own), "trie-full")

    totals = rollup(vertices(full), members, full, most)
    last = members.join(convs.select("conv", F.col("n").alias("d")).where("d > 0"), ["conv", "d"]).select("name", "conv")
    ends = ends_of(last.unionByName(convs.where("n = 0").select(root_name(), "conv")))
    inside = below_in_run(full)  # what the nodes of its own vertex add below a node
    out = full.join(inside, ["conv", "n", "d"]).join(totals, ["conv", "n"]).join(ends, "name", "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select(
        F.col("conv").alias("conv_id"), F.col("d").alias("depth"), F.col("up_conv").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("n_children").cast("long").alias("n_children"), F.col("leaves").alias("n_leaves"),
        (F.col("under") + F.col("inside")).cast("long").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )


def below_in_run(nodes: DataFrame) -> DataFrame:
    """conv, n, d, inside: the own values of a vertex's nodes from d downwards, in runs of RUN nodes."""
    cells = nodes.select("conv", "n", "d", "own", F.floor(F.col("d") / RUN).alias("run"))
    runs = cells.groupBy("conv", "n", "run").agg(F.sum("own").alias("s"))
    after = Window.partitionBy("conv", "n").orderBy(F.desc("run")).rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("conv", "n", "run", F.coalesce(F.sum("s").over(after), F.lit(0)).alias("later"))
    within = Window.partitionBy("conv", "n", "run").orderBy(F.desc("d")).rowsBetween(Window.unboundedPreceding, 0)
    cells = cells.withColumn("here", F.sum("own").over(within)).join(runs, ["conv", "n", "run"])
    return cells.select("conv", "n", "d", (F.col("here") + F.col("later")).alias("inside"))


# ---- centroid decomposition ------------------------------------------------------------------------------
def vertices(nodes: DataFrame) -> DataFrame:
    """Nodes with the same members as one vertex: id, conv, n, top, bottom, saved, leaves, parent's conv and n."""
    found = nodes.groupBy("conv", "n").agg(
        F.min("d").alias("top"), F.max("d").alias("bottom"), F.sum("own").alias("saved"),
        F.max((F.col("n_children") == 0).cast("long")).alias("leaves"),
        F.min(F.struct("d", "up_conv", "up_n")).alias("up"),
    )
    found = found.select("conv", "n", "top", "bottom", "saved", "leaves", "up.up_conv", "up.up_n")
    return written(found.withColumn("id", F.monotonically_increasing_id()), "trie-vertices")


STATE = ["id", "up", "conv", "n", "top", "bottom", "w", "saved", "leaves", "more_saved", "more_leaves", "comp"]


def rollup(found: DataFrame, members: DataFrame, nodes: DataFrame, most: int) -> DataFrame:
    """conv, n, under (saved below the vertex), leaves (of its subtree)."""
    ids = found.select(F.col("conv").alias("up_conv"), F.col("n").alias("up_n"), F.col("id").alias("up"))
    kids = found.groupBy("up_conv", "up_n").agg(F.count("*").alias("n")).where("up_conv is not null")
    key = F.struct("up_conv", "up_n")
    parents = ids.select(key.alias("key"), "up")
    linked = looked_up(found.where("up_conv is not null").withColumn("key", key), parents, "key", kids.select(key.alias("key"), "n")).drop("key")
    zero = F.lit(0).cast("long")
    state = linked.unionByName(found.where("up_conv is null"), allowMissingColumns=True)
    state = state.withColumns({"w": F.col("n"), "more_saved": zero, "more_leaves": zero, "comp": F.lit(-1).cast("long")}).select(STATE)
    state = written(state, "trie-state")
    total = state.count()
    most, place, done = max(most, total // COMPONENTS), None, []
    while True:
        sizes = state.groupBy("comp").agg(F.count("*").alias("size"), F.max("w").alias("whole"))
        large = written(sizes.where(F.col("size") > most), "trie-large")  # at most COMPONENTS rows
        if large.isEmpty():
            break
        if place is None:
            place = written(places(state, members, nodes), "trie-places")
        done.append(state.join(F.broadcast(large.select("comp")), "comp", "left_anti"))
        state = written(split(state.join(F.broadcast(large), "comp"), place), "trie-state")
    for part in done:
        state = state.unionByName(part)
    return finished(state, total)


def places(state: DataFrame, members: DataFrame, nodes: DataFrame) -> DataFrame:
    """conv, d, child, parent: the vertex that starts with turn d of conv, for conversations that name vertices."""
    names = members.join(state.select("conv").distinct(), "conv", "left_semi").select("conv", "d", "name")
    tops = nodes.join(state.select("conv", F.col("top").alias("d"), F.col("id").alias("child"), F.col("up").alias("parent")), ["conv", "d"])
    tops = tops.select("name", "child", "parent", "n")
    found = looked_up(names, tops.drop("n"), "name", tops.select("name", "n"))
    return found.where("child is not null").select("conv", "d", "child", "parent")


def split(state: DataFrame, place: DataFrame) -> DataFrame:
    """One round: centroids leave, totals go up their paths, components fall apart. state has size, whole."""
    on_path = 2 * F.col("w") > F.col("whole")
    lowest = F.max(F.struct("top", "id", "bottom", "w", "conv")).alias("c")
    centre = state.where(on_path).groupBy("comp").agg(lowest).select(
        "comp", F.col("c.id").alias("centre"), F.col("c.bottom").alias("below"), F.col("c.w").alias("centre_w")
    )
    rows = state.join(F.broadcast(centre), "comp")  # one row per component
    here = place.select("conv", (F.col("d") - 1).alias("below"), "child", F.col("parent").alias("centre"))
    rows = rows.join(here, ["conv", "below", "centre"], "left")
    # A vertex further up has the centroid's child on its way too if they share a conversation.
    under = F.col("child").isNotNull() & (F.col("top") > F.col("below"))
    own = F.col("id") == F.col("centre")
    rows = written(rows.withColumns({"under": under, "self": own, "on_path": on_path}), "trie-round")
    sums = rows.where("under or self").groupBy("centre").agg(F.sum("saved").alias("part_saved"), F.sum("leaves").alias("part_leaves"))
    rows = rows.join(F.broadcast(sums), "centre")  # one row per component
    add = lambda what: F.col(f"more_{what}") + F.when(F.col("self"), F.col(f"part_{what}") - F.col(what)).when(
        F.col("on_path"), F.col(f"part_{what}")
    ).otherwise(0)
    changed = {
        "more_saved": add("saved"), "more_leaves": add("leaves"),
        "w": F.when(F.col("on_path") & ~F.col("self"), F.col("w") - F.col("centre_w")).otherwise(F.col("w")),
        "comp": F.when(F.col("self"), F.col("centre")).when(F.col("under"), F.col("child")).otherwise(F.col("comp")),
        "up": F.when(F.col("self") | (F.col("up") == F.col("centre")), F.lit(None)).otherwise(F.col("up")),
    }
    # The part above keeps its component's name, that of its top vertex (-1 for the root's).
    return rows.withColumns(changed).select(STATE)


def finished(state: DataFrame, total: int) -> DataFrame:
    """Decompose small components, several of them in each task."""
    buckets = max(1, total // (8 * MOST))

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        at = pd.Series(np.arange(len(rows)), index=rows["id"].to_numpy())
        up = at.reindex(rows["up"]).fillna(-1).to_numpy().astype(np.int64)
        comp = rows["comp"].to_numpy()
        up = np.where((up >= 0) & (comp[up] == comp), up, -1)
        own = rows[["saved", "leaves"]].to_numpy(np.int64)
        sums = subtree_sums(up, rows["top"].to_numpy(), rows["w"].to_numpy(np.int64), own, comp)
        sums += rows[["more_saved", "more_leaves"]].to_numpy(np.int64)
        return pd.DataFrame({"conv": rows["conv"], "n": rows["n"], "under": sums[:, 0] - own[:, 0], "leaves": sums[:, 1]})

    dealt = state.withColumn("bucket", F.pmod(F.xxhash64("comp"), F.lit(buckets)))
    return dealt.groupBy("bucket").applyInPandas(work, "conv long, n long, under long, leaves long")


def subtree_sums(up: np.ndarray, depth: np.ndarray, weight: np.ndarray, own: np.ndarray, comp: np.ndarray) -> np.ndarray:
    """Sums of ``own`` over subtrees of a forest by centroid decomposition; weight: of whole subtrees."""
    order = np.lexsort((depth, comp))
    cuts = np.flatnonzero(np.diff(comp[order], prepend=comp[order][:1])) if len(order) else []
    left = np.split(order, cuts)
    w, out = weight.copy(), np.zeros_like(own)
    side = np.full(len(up), -1)
    up_list = up.tolist()
    while left:
        rows = left.pop()
        if len(rows) <= SMALL or w[rows[0]] <= 0:
            here = {int(i): own[i].copy() for i in rows}
            for i in reversed(rows.tolist()):
                out[i] += here[i]
                if up_list[i] in here:
                    here[up_list[i]] += here[i]
            continue
        path = rows[2 * w[rows] > w[rows[0]]]
        centre = int(path[-1])
        side[rows] = -1
        for i in rows.tolist():
            if up_list[i] == centre:
                side[i] = i
            elif up_list[i] >= 0 and side[up_list[i]] >= 0 and i != centre:
                side[i] = side[up_list[i]]
        below = rows[side[rows] >= 0]
        part = own[centre] + own[below].sum(0)
        out[path] += part
        w[path[:-1]] -= w[centre]
        groups = below[np.argsort(side[below], kind="stable")]
        left += [g for g in np.split(groups, np.flatnonzero(np.diff(side[groups])) + 1) if len(g)]
        above = rows[(side[rows] < 0) & (rows != centre)]
        for i in groups.tolist():
            if up_list[i] == centre:
                up_list[i] = -1
        if len(above):
            left.append(above)
    return out
