"""Removal of long byte strings that occur more than once, by names at chosen positions.

This is not prefix doubling: nothing is sorted or reranked at growing offsets. A position is named by the
string of ``h`` bytes that starts there, for two lengths only. Positions whose name is unique are settled
(no longer string from there is repeated) and drop out. Only equality matters here, not order, so
a name is a fingerprint of the string, the same wherever it is made, and Spark brings equal names
together by a shuffle. What is removed is decided by 96 bits of BLAKE2 over the strings themselves; the
fast fingerprints that choose positions only find candidates.

Half the threshold (``h`` = 200) is named at chosen positions only: among the halves inside a window of
threshold length the one with the least fingerprint, leftmost of equals. Equal windows choose equally, so
nothing is missed, and about one position in a hundred is left. A chosen position stands for the run of
windows that choose it.

1. Chosen positions whose name is unique settle all their windows as unique.
2. If the whole text over which the run of windows stretches occurs again around an equal name, all its
   windows are repeated.
3. What is left are runs at the borders of repeats. Only there every window is named in full (``h`` =
   400), together with one run of each kind met in step 2, and names that occur twice are repeated.

Texts are looked at as UTF-8 bytes. The texts needed in step 3 and those with something to remove
travel compressed; the others stay where they were read. Texts that occur more than once as a whole are
removed by that fact alone.

Cases: null and empty texts have no bytes; texts shorter than the threshold keep all; repeats inside one
document and overlapping ones count; repeated rows and doc_ids are judged by their texts; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm.common import batches, discard, texts, written
from voxloom.llm.jaccard_join import BASE, FILTER_BITS, mixed, perhaps, slices, wanted_bits
from voxloom.session import scratch_path

ANCHORS = "name long, around long, around_more int, key long, key_more int, first int, last int"
WINDOWS = "name long, full long, full_more int, key long, key_more int, start int"
BLOCK = 1 << 22  # windows of one text that are named at a time
KEY = ["key", "key_more"]
DIGEST = np.dtype([("most", "<i8"), ("more", "<i4")])


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Names:
    """Fast names of all strings of one length, from prefix sums; unequal strings may share one."""

    def __init__(self):
        self.n = 0
        self.up = self.down = np.ones(1, np.uint64)

    def every(self, data: bytes, length: int) -> np.ndarray:
        raw = np.frombuffer(data, np.uint8)
        if len(raw) > self.n:
            self.n = len(raw)
            self.up, self.down = powers(BASE, self.n), powers(pow(BASE, -1, 1 << 64), self.n)
        terms = (raw + np.uint64(1)) * self.up[: len(raw)]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
        return mixed((sums[length:] - sums[:-length]) * self.down[: len(raw) - length + 1])


def digests(strings: Iterable[bytes]) -> np.ndarray:
    """96 bits that stand for each of the strings."""
    return np.frombuffer(b"".join(hashlib.blake2b(s, digest_size=12).digest() for s in strings), DIGEST)


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` neighbours, by doubling."""
    have = 1
    while have * 2 <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    return np.minimum(values[: len(values) - (width - have)], values[width - have :]) if width > have else values


def runs(names: Names, data: bytes, threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Chosen positions with their names and the first and last window start that chooses them."""
    half, windows = threshold // 2, len(data) - threshold + 1
    found = []
    for at in range(0, windows, BLOCK):
        halves = names.every(data[at : min(at + BLOCK, windows) + threshold - 1], half)
        # The upper bits of the name, then the position: the least is the leftmost of the least names.
        packed = (halves & ~np.uint64((1 << 28) - 1)) | np.arange(len(halves), dtype=np.uint64)
        chosen = (least_of(packed, threshold - half + 1) & np.uint64((1 << 28) - 1)).astype(np.int64)
        begin = np.flatnonzero(np.diff(chosen, prepend=-1))
        found.append((chosen[begin] + at, halves[chosen[begin]], begin + at))
    chosen, name, first = (np.concatenate(c) for c in zip(*found))
    new = np.diff(chosen, prepend=-1) != 0  # a run goes on over the border of blocks
    chosen, name, first = chosen[new], name[new], first[new]
    return chosen, name.view(np.int64), first, np.append(first[1:], windows) - 1


def key_of(data: bytes) -> tuple[int, int]:
    return digests([data])[0].item()


def anchors(docs: DataFrame, threshold: int) -> DataFrame:
    """A row for every chosen position: its name, that of the text its windows stretch over, the text's key, windows."""

    def choose(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = Names()
        for batch in slices(rows, 1 << 20):
            out: list[list[np.ndarray]] = [[], [], [], [], [], [], []]
            for text in batch.column(1).to_pylist():
                data = text.encode()
                if len(data) < threshold:
                    continue
                at, name, first, last = runs(names, data, threshold)
                around = digests(
                    b"%d,%d:" % (place, windows) + data[start : start + windows + threshold]
                    for place, start, windows in zip((at - first).tolist(), first.tolist(), (last - first).tolist())
                )
                key, more = key_of(data)
                for column, values in zip(out, (name, around["most"], around["more"], np.full(len(at), key), np.full(len(at), more), first, last)):
                    column.append(values)
            if out[0]:
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
                columns = [pa.array(np.concatenate(c), k) for c, k in zip(out, kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["name", "around", "around_more", *KEY, "first", "last"])

    return docs.mapInArrow(choose, ANCHORS)


def carrying(docs: DataFrame, keys: DataFrame, whole: bool) -> DataFrame:
    """doc_id, key, size and sha256 of every text; its compressed bytes only if its key may be wanted.

    With ``whole`` false only the rows that may be wanted are returned.
    """
    sent = docs.sparkSession.sparkContext.broadcast(wanted_bits(keys.select(F.col("key").alias("id"))))  # 8 MB at any scale

    def carry(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, press = sent.value.view(np.uint64), zstandard.ZstdCompressor(level=1)
        for batch in batches(rows):
            doc_ids, found = batch.column(0).to_pylist(), [t.encode() for t in batch.column(1).to_pylist()]
            out = []
            for doc_id, data, bit in zip(doc_ids, found, batch.column(2).to_pylist()):
                wanted = bool(int(bitmap[bit >> 6]) >> (bit & 63) & 1)
                if wanted or whole:
                    out.append((doc_id, *key_of(data), len(data), hashlib.sha256(data).hexdigest() if whole else None, press.compress(data) if wanted else None))
            columns = [pa.array([r[k] for r in out], kind) for k, kind in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", *KEY, "size", "sha256", "data"])

    return docs.select("doc_id", "text", "bit").mapInArrow(carry, "doc_id long, key long, key_more int, size long, sha256 string, data binary")


def with_bits(docs: DataFrame) -> DataFrame:
    """The place of each text's key in the bitmap of wanted keys."""

    def bits(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows):
            keys = pa.array([key_of(t.encode())[0] for t in batch.column(1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, keys], ["doc_id", "text", "key"])

    keyed = docs.mapInArrow(bits, "doc_id long, text string, key long")
    return keyed.select("doc_id", "text", F.pmod(F.xxhash64("key"), F.lit(1 << FILTER_BITS)).alias("bit"))


def full_names(texts_of: DataFrame, threshold: int) -> DataFrame:
    """A row for every window of the runs: the run's name, the window's own; texts_of: key, key_more, data, runs."""

    def explode(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        for batch in batches(rows, 32):
            for key, more, data, found in zip(*(c.to_pylist() for c in batch.columns)):
                data = press.decompress(data)
                sizes = [r["last"] - r["first"] + 1 for r in found]
                name = np.repeat(np.array([r["name"] for r in found], np.int64), sizes)
                start = np.concatenate([np.arange(r["first"], r["last"] + 1, dtype=np.int32) for r in found])
                for at in range(0, len(start), 1 << 16):
                    some = start[at : at + (1 << 16)]
                    full = digests(data[p : p + threshold] for p in some.tolist())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(name[at : at + (1 << 16)]), pa.array(full["most"].copy()), pa.array(full["more"].copy()),
                         pa.array(np.full(len(some), key)), pa.array(np.full(len(some), more, np.int32)), pa.array(some)],
                        ["name", "full", "full_more", *KEY, "start"],
                    )

    return texts_of.select(*KEY, "data", "runs").mapInArrow(explode, WINDOWS)


def repeated(docs: DataFrame, threshold: int) -> tuple[DataFrame, DataFrame]:
    """Keys of texts that occur more than once; key, first, last of repeated windows in other texts."""
    around = ["around", "around_more"]
    path = scratch_path(docs.sparkSession, "suffix-anchors")
    rows = written(anchors(docs, threshold), "", path)
    copied = rows.where("first = 0").groupBy(KEY).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(KEY)
    copied = written(copied, "suffix-copied")
    names = rows.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("name")
    names = written(names, "suffix-names")
    # Copies of a text are counted, not kept apart: a group of copies is one row for each position.
    live = perhaps(rows, names, "name").join(names, "name").groupBy("name", *around, *KEY, "first", "last").agg(F.count(F.lit(1)).alias("n"))
    live = written(live, "suffix-live")
    discard(docs.sparkSession, path)
    kinds = live.groupBy("name", *around).agg(F.sum("n").alias("n"), F.min(F.struct(*KEY, "first", "last")).alias("one"))
    kinds = written(kinds, "suffix-kinds")
    again = live.join(kinds.where("n > 1").select("name", *around), ["name", *around]).select(*KEY, "first", "last")
    # Names with a run that is met once and another kind of run: only these are open.
    open_names = kinds.groupBy("name").agg(F.min("n").alias("least"), F.count(F.lit(1)).alias("kinds"))
    open_names = open_names.where("least = 1 AND kinds > 1").select("name")
    ones = kinds.join(open_names, "name").select("name", "one.*").groupBy(KEY)
    ones = written(ones.agg(F.collect_list(F.struct("name", "first", "last")).alias("runs")), "suffix-open")
    data = carrying(with_bits(docs), ones.select("key"), whole=False).where("data is not null")
    data = data.groupBy(KEY).agg(F.min("data").alias("data"))
    full = written(full_names(data.join(ones, KEY), threshold), "suffix-full")
    window = ["name", "full", "full_more"]
    twice = full.groupBy(window).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(window)
    twice = written(twice, "suffix-twice")
    edge = perhaps(full, twice, "full").join(twice, window).select(*KEY, F.col("start").alias("first"), F.col("start").alias("last"))
    return copied, again.unionByName(edge).join(copied, KEY, "left_anti").distinct()


def merged(windows: list[dict], threshold: int) -> list[list[int]]:
    out: list[list[int]] = []
    for first, stop in sorted((w["first"], w["last"] + threshold) for w in windows):
        if out and first <= out[-1][1]:
            out[-1][1] = max(stop, out[-1][1])
        else:
            out.append([first, stop])
    return out


def deduplicated(docs: DataFrame, *, threshold: int = 400) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (removed bytes) of every document."""
    docs = texts(docs)
    copied, windows = repeated(docs, threshold)
    by_key = windows.groupBy(KEY).agg(F.collect_list(F.struct("first", "last")).alias("windows"))
    by_key = written(by_key, "suffix-windows")
    marks = by_key.select(*KEY, "windows", F.lit(False).alias("copied"))
    marks = marks.unionByName(copied.select(*KEY, F.lit(None).cast("array<struct<first:int,last:int>>").alias("windows"), F.lit(True).alias("copied")))
    rows = carrying(with_bits(docs), by_key.select("key"), whole=True).join(marks, KEY, "left")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,stop:long>>"

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        for batch in batches(parts, 64):
            out = []
            for doc_id, size, digest, data, found, copy in zip(*(c.to_pylist() for c in batch.columns)):
                spans = [[0, size]] if copy else merged(found or [], threshold)
                if spans:
                    whole = b"" if copy else press.decompress(data)
                    places = [0, *(p for span in spans for p in span), size]
                    kept = b"" if copy else b"".join(whole[a:b] for a, b in zip(places[::2], places[1::2]))
                    digest = hashlib.sha256(kept).hexdigest()
                out.append({
                    "doc_id": doc_id, "n_bytes": size, "n_removed": sum(b - a for a, b in spans), "n_spans": len(spans),
                    "kept_sha256": digest, "spans": [{"start": a, "stop": b} for a, b in spans],
                })
            span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            kinds = [pa.int64()] * 4 + [pa.string(), span]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
            yield pa.RecordBatch.from_pylist(out, pa.schema(list(zip(names, kinds))))

    return rows.select("doc_id", "size", "sha256", "data", "windows", "copied").mapInArrow(cut, schema)
