"""Exact Jaccard join of documents on word n-grams, by rare-first prefix filtering.

A document's set holds its distinct shingles of ``size`` words. Two sets of the wanted similarity share a
shingle among the first few of each, in any order common to all documents. The order here is rare first:
a table of about a million counters, filled by all documents, says how frequent a shingle is (its size is
fixed; two shingles on one counter only make the order a little worse, never the result).

1. Documents with the same words in the same order form a class, kept by its smallest doc_id.
2. Every class sends its first shingles with set size and place to an index; shingles of one class only
   drop out.
3. In each index group the classes are compared with one of them. Links found that way join most near
   copies into components without ever pairing all of a group.
4. What is left are pairs of classes of one group in different components; the members outside a group's
   largest component are paired with the rest. No other pair can add a link between components.

Before texts are looked at, pairs go through the length filter and the positional filter (how much can
still overlap behind the shared places); then through the suffix filter, and are counted exactly, once.
The texts of pairs travel compressed, and only those of documents in a pair. Hashed shingles only find
pairs and pass the filters; a pair is linked by its words, and a class is named by 128 bits of BLAKE2.

Cases: null and empty texts, or texts of white space, have no shingle and are linked with nothing; a
text of fewer words is one shingle of all its words; rows that share a doc_id are one document with the
links of each; a row without doc_id links nothing and gets the component of the documents with the very
same words, if there are any; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm.common import batches, discard, texts, written
from voxloom.llm.components import components
from voxloom.session import cut_lineage, scratch_path

BITS = 20  # of the counter table
CHUNK = 14  # bits of the counters in one row
FAN = 64  # counter rows of one task that are summed up together
FILTER_BITS = 26  # of the bitmap of wanted documents
BASE = 0x9E3779B97F4A7C15
M1, M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * M1
    x = (x ^ (x >> np.uint64(27))) * M2
    return x ^ (x >> np.uint64(31))


def words_of(text: str) -> list[bytes]:
    """Words with A-Z lower-cased; bytes are split at 0x20 and 0x09 to 0x0D."""
    return text.encode("utf-8").lower().split()


def exact_set(words: list[bytes], size: int, known: dict[bytes, int]) -> np.ndarray:
    """The set itself: each shingle as the numbers that its words have in ``known``."""
    width = min(size, len(words))
    if not width:
        return np.zeros(0, np.dtype((np.void, 4)))
    numbers = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int32, len(words))
    rows = np.lib.stride_tricks.sliding_window_view(numbers, width)
    return np.unique(np.ascontiguousarray(rows).view(np.dtype((np.void, 4 * width))).ravel())


def shared(x: np.ndarray, y: np.ndarray) -> int:
    """How many shingles two sets share; those of unequal width never are equal."""
    return len(np.intersect1d(x, y, assume_unique=True)) if x.dtype == y.dtype else 0


def class_of(words: list[bytes]) -> tuple[int, int]:
    """128 bits that stand for the words in their order."""
    digest = hashlib.blake2b(b" ".join(words), digest_size=16).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def shingles(words: list[bytes], size: int) -> np.ndarray:
    """The set as sorted 64-bit names. They find candidates; ``verified`` compares the words themselves."""
    width = min(size, len(words))
    if not width:
        return np.zeros(0, np.uint64)
    names = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    total = np.full(len(names) - width + 1, width, np.uint64)
    for k in range(width):
        total = mixed(total * np.uint64(BASE) + names[k : len(names) - width + 1 + k])
    return np.unique(total)


def slices(rows: Iterator[pa.RecordBatch], most: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """Arrow rows with about ``most`` bytes of texts (second column) at a time."""
    for batch in batches(rows, 512):
        sizes = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            done = sizes[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(sizes, done + most, "right")))
            yield batch.slice(at, stop - at)
            at = stop
    pa.default_memory_pool().release_unused()  # the worker lives on, for other tasks


def profiles(docs: DataFrame, size: int) -> tuple[DataFrame, np.ndarray]:
    """doc_id, n, sig, more of every document, and how frequent the shingles of each counter are."""

    def profile(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << BITS, np.int64)
        names = ["doc_id", "n", "sig", "more", "chunk", "part", "counts"]
        for batch in slices(rows):
            found = [words_of(t) for t in batch.column(1).to_pylist()]
            sets = [shingles(words, size) for words in found]
            place, times = np.unique(np.concatenate(sets) >> np.uint64(64 - BITS), return_counts=True)
            counts[place] += times
            sig, more = zip(*map(class_of, found))
            none = [None] * len(sets)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int32()), pa.array(sig, pa.int64()), pa.array(more, pa.int64()),
                 pa.array(none, pa.int32()), pa.array(none, pa.int32()), pa.array(none, pa.binary())], names,
            )
        chunks = np.minimum(counts, (1 << 31) - 1).astype("<u4").reshape(-1, 1 << CHUNK)
        n, part = len(chunks), TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [pa.array([None] * n, pa.int64()), pa.array([None] * n, pa.int32()), pa.array([None] * n, pa.int64()), pa.array([None] * n, pa.int64()),
             pa.array(range(n), pa.int32()), pa.array([part] * n, pa.int32()),
             pa.array([c.tobytes() for c in chunks], pa.binary())], names,
        )

    schema = "doc_id long, n int, sig long, more long, chunk int, part int, counts binary"
    rows = written(docs.mapInArrow(profile, schema), "jaccard-profiles")
    return rows.where("chunk is null").select("doc_id", "n", "sig", "more"), frequencies(rows.where("chunk is not null"))


def frequencies(chunks: DataFrame) -> np.ndarray:
    """All counters summed up, as levels: a quarter of a doubling each."""
    chunks = chunks.select("chunk", "part", "counts")

    def add(key: tuple, table: pa.Table) -> pa.Table:
        arrays = [np.frombuffer(c, "<u4").astype(np.int64) for c in table["counts"].to_pylist()]
        total = np.minimum(np.sum(arrays, axis=0), (1 << 32) - 1).astype("<u4").tobytes()
        return pa.table({"chunk": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([key[1].as_py()], pa.int32()), "counts": pa.array([total], pa.binary())})

    parts = (chunks.agg(F.max("part")).first()[0] or 0) + 1
    while parts:
        chunks = chunks.withColumn("part", F.floor(F.col("part") / FAN).cast("int"))
        chunks = chunks.groupBy("chunk", "part").applyInArrow(add, chunks.schema)
        parts = 0 if parts <= FAN else -(-parts // FAN)
    found = chunks.toArrow()  # as many rows as there are chunks, whatever the input
    counts = np.zeros((1 << (BITS - CHUNK), 1 << CHUNK))
    for chunk, data in zip(found["chunk"].to_pylist(), found["counts"].to_pylist()):
        counts[chunk] += np.frombuffer(data, "<u4")
    return np.floor(4 * np.log2(1 + counts.ravel())).astype(np.uint8)


def index(docs: DataFrame, size: int, share: tuple[int, int], levels: np.ndarray) -> DataFrame:
    """token, n, sig, place for the first shingles of every document that can decide."""
    num, den = share
    sent = docs.sparkSession.sparkContext.broadcast(levels)  # one byte for each counter

    def prefixes(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = sent.value
        for batch in slices(rows):
            tokens, counts, ns, sigs = [], [], [], []
            for words in map(words_of, batch.column(1).to_pylist()):
                s = shingles(words, size)
                n = len(s)
                length = n - -(-num * n // den) + 1 if n else 0
                order = np.argsort(levels[s >> np.uint64(64 - BITS)], kind="stable")[:length]
                tokens.append(s[order].view(np.int64))
                counts.append(length)
                ns.append(n)
                sigs.append(class_of(words)[0])
            counts = np.array(counts)
            place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(tokens)), pa.array(np.repeat(np.array(ns, np.int32), counts)),
                 pa.array(np.repeat(np.array(sigs, np.int64), counts)), pa.array(place.astype(np.int32))],
                ["token", "n", "sig", "place"],
            )

    return docs.mapInArrow(prefixes, "token long, n int, sig long, place int")


def can_link(share: tuple[int, int]) -> F.Column:
    """Length and positional filter for the rows x and y of one index group.

    ``needed``: the least overlap of two such sets. Behind the first shared place of both no more can
    be shared than is left of the shorter rest; a pair that links passes at its first shared token.
    """
    num, den = share
    nx, ny = F.col("x.n").cast("long"), F.col("y.n").cast("long")
    needed = F.ceil((nx + ny) * num / (num + den) - 1e-9)
    rest = 1 + F.least(nx - F.col("x.place") - 1, ny - F.col("y.place") - 1)
    return (F.least(nx, ny) * den >= F.greatest(nx, ny) * num) & (rest >= needed)


def overlap_bound(x: np.ndarray, y: np.ndarray, depth: int = 2) -> int:
    """Suffix filter: no more than this can be shared, found by splitting both sets at a middle value."""
    if not depth or len(x) < 2 or len(y) < 2:
        return min(len(x), len(y))
    middle = y[len(y) // 2]
    at, to = np.searchsorted(x, middle), len(y) // 2
    return overlap_bound(x[:at], y[:to], depth - 1) + overlap_bound(x[at:], y[to:], depth - 1)


def enough(inter: int, x: int, y: int, share: tuple[int, int]) -> bool:
    num, den = share
    return den * inter >= num * (x + y - inter)


def wanted_bits(ids: DataFrame) -> np.ndarray:
    """A bitmap of fixed size that has the bit of every id; other ids may share one."""
    bit = F.pmod(F.xxhash64("id"), F.lit(1 << FILTER_BITS))
    words = ids.select(bit.alias("bit")).groupBy(F.floor(F.col("bit") / 64).alias("word"))
    found = words.agg(F.expr("bit_or(shiftleft(1L, cast(bit % 64 as int))) AS bits")).toArrow()
    bitmap = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    bitmap[found["word"].to_numpy()] = found["bits"].to_numpy()
    return bitmap


def perhaps(rows: DataFrame, wanted: DataFrame, id_col: str) -> DataFrame:
    """The rows whose id may be wanted, by a bitmap of fixed size: what a join drops is not shuffled."""
    sent = rows.sparkSession.sparkContext.broadcast(wanted_bits(wanted.select(F.col(id_col).alias("id"))))
    names = rows.columns

    def keep(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = sent.value.view(np.uint64)
        for batch in parts:
            bit = batch.column(len(names)).to_numpy()
            held = (bitmap[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1) == 1
            yield batch.select(names).filter(pa.array(held))

    bit = F.pmod(F.xxhash64(id_col), F.lit(1 << FILTER_BITS)).alias("_bit")
    return rows.select("*", bit).mapInArrow(keep, rows.schema)


def verified(docs: DataFrame, pairs: DataFrame, size: int, share: tuple[int, int]) -> DataFrame:
    """Those of the pairs a, b whose sets are similar enough."""
    ids = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
    sent = docs.sparkSession.sparkContext.broadcast(wanted_bits(ids))  # 8 MB, whatever the input

    def wanted(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, press = sent.value.view(np.uint64), zstandard.ZstdCompressor(level=1)
        for batch in batches(rows):
            bit = batch.column(2).to_numpy()
            keep = (bitmap[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1) == 1
            batch = batch.filter(pa.array(keep))
            blobs = pa.array([press.compress(t.encode()) for t in batch.column(1).to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), blobs], ["id", "text"])

    bit = F.pmod(F.xxhash64("doc_id"), F.lit(1 << FILTER_BITS)).alias("bit")
    found = docs.where("doc_id is not null").select("doc_id", "text", bit).mapInArrow(wanted, "id long, text binary")
    found = cut_lineage(found.join(ids.distinct(), "id", "left_semi"))
    rows = pairs.join(found.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    rows = rows.join(found.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")

    def compare(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdDecompressor()
        last, left, left_set, known = None, None, None, {}
        for batch in batches(parts):
            links = []
            for a, b, text_a, text_b in zip(*(c.to_pylist() for c in batch.columns)):
                if last != (a, text_a) or len(known) > 1 << 20:
                    words, known = words_of(press.decompress(text_a).decode()), {}
                    last, left, left_set = (a, text_a), shingles(words, size), exact_set(words, size, known)
                words = words_of(press.decompress(text_b).decode())
                right = shingles(words, size)
                if enough(overlap_bound(left, right), len(left), len(right), share):
                    right_set = exact_set(words, size, known)
                    if enough(shared(left_set, right_set), len(left_set), len(right_set), share):
                        links.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], ["a", "b"])

    linked = rows.select("a", "b", "text_a", "text_b").mapInArrow(compare, "a long, b long")
    return cut_lineage(linked.distinct())


def jaccard_components(docs: DataFrame, *, size: int = 3, share: tuple[int, int] = (90, 100)) -> DataFrame:
    """doc_id, n_shingles, component_id; ``share`` is the similarity as a fraction."""
    docs = texts(docs)
    rows, levels = profiles(docs, size)
    classes = rows.where("n > 0").groupBy("sig", "more", "n").agg(F.min("doc_id").alias("id")).where("id is not null")
    path = scratch_path(docs.sparkSession, "jaccard-index")
    first = written(index(docs, size, share, levels), "", path)
    common = first.groupBy("token").agg(F.min("sig").alias("least"), F.max("sig").alias("most"))
    common = written(common.where("least != most").select("token"), "jaccard-shared")
    live = perhaps(first, common, "token").join(common, "token").distinct().join(classes.select("sig", "n", "id"), ["sig", "n"]).select("token", "id", "n", "place")
    live = written(live, "jaccard-live")
    discard(docs.sparkSession, path)

    # One of each group, by length band, is compared with the others: one with few rarer shingles before the
    # shared one, so a text from which the others were made rather than one with changes of its own.
    band = F.floor(F.log(F.col("n").cast("double")) / float(np.log(share[1] / share[0]))).alias("band")
    choice = F.struct("place", F.xxhash64("id", F.col("token").bitwiseAND(F.lit(1))))
    banded = live.select("*", band)
    leads = banded.groupBy("token", "band").agg(F.min_by(F.struct("id", "n", "place"), choice).alias("lead"))
    leads = leads.select("token", "band", "lead.*")
    pairs = banded.alias("x").join(leads.alias("y"), ["token", "band"]).where(F.col("x.id") != F.col("y.id"))
    pairs = cut_lineage(as_pairs(pairs.where(can_link(share))))
    own = cut_lineage(same_document(rows, classes))
    links = verified(docs, pairs, size, share)
    found = components(links.unionByName(own))

    placed = live.join(found, "id", "left").select("*", F.coalesce("component", "id").alias("of"))
    placed = cut_lineage(placed.select("token", "id", "n", "place", "of"))
    sizes = placed.groupBy("token", "of").agg(F.count(F.lit(1)).alias("members"))
    largest = sizes.groupBy("token").agg(F.max(F.struct("members", "of")).alias("top"), F.count(F.lit(1)).alias("kinds"))
    mixed_groups = largest.where("kinds > 1").select("token", F.col("top.of").alias("main"))
    rest = placed.join(mixed_groups, "token").where("of != main")
    other = rest.alias("x").join(
        placed.alias("y"),
        (F.col("x.token") == F.col("y.token")) & (F.col("x.of") != F.col("y.of"))
        & ((F.col("y.of") == F.col("x.main")) | (F.col("x.id") < F.col("y.id"))) & can_link(share),
    )
    other = cut_lineage(as_pairs(other).join(pairs, ["a", "b"], "left_anti"))
    more = verified(docs, other, size, share)
    edges = more.unionByName(found.select(F.col("id").alias("a"), F.col("component").alias("b")))
    found = components(edges)

    of = classes.join(found, "id", "left").select("sig", "more", "n", F.coalesce("component", "id").alias("component_id"))
    out = rows.join(of, ["sig", "more", "n"], "left")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), own.alias("component_id"))


def same_document(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Links a, b between a doc_id that has several texts and the classes of each of them."""
    held = rows.where("n > 0 and doc_id is not null")
    key = F.struct("sig", "more")
    several = held.groupBy("doc_id").agg(F.min(key).alias("least"), F.max(key).alias("most")).where("least != most")
    held = held.join(several.select("doc_id"), "doc_id", "left_semi").join(classes, ["sig", "more", "n"])
    return held.where("doc_id != id").select(F.col("doc_id").alias("a"), F.col("id").alias("b")).distinct()


def as_pairs(rows: DataFrame) -> DataFrame:
    return rows.select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b")).distinct()
