"""Mixture-controlled packing: deficit round-robin over source queues.

Every document is encoded once and dealt by a hash into buckets of about ``bucket_ids`` ids. A bucket
packs its documents into windows of ``length`` ids. Each window credits every source with its target
share of the window; a source pays for the ids it puts in, and what it could not use stays as its deficit
for later windows. The deficits a bucket starts with are those that all buckets before it leave behind;
as a bucket packs all its ids, they follow from token counts alone, so buckets need not wait for each
other. Documents are cut where a window or the credit ends, but no piece is shorter than ``least`` ids
unless it ends its document or its window.

Every window is full. What is left at the end of a bucket becomes windows whose lengths are powers of
two, so nothing is padded.

``targets`` maps sources to weights (default: the share each source has of all ids). A source without a
weight, or one that has run out, gives its room to the source with the highest deficit.

Cases: null and empty texts are documents of the end id alone; a null source is a source of its own;
repeated rows are packed as often as they occur; an empty table gives no piece; columns other than
doc_id, text and source are ignored.
A special token's string in a text becomes that token, as the library's plain call has it.
"""

from __future__ import annotations

import math
import zlib
from collections import deque
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxloom.llm.common import batches, encoder, texts, written

BUCKET_IDS = 1 << 20
GROUP = 1024  # buckets whose counts are summed up together
ENCODED = "doc_id long, source string, deal long, n long, ids binary"
PIECES = (
    "doc_id long, source string, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, ids binary"
)


def encoded(docs: DataFrame, tokenizer: str, end_id: int, width: int) -> DataFrame:
    """The ids of every document, written once; ``deal`` spreads even equal rows."""

    def encode(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], "<u4")
        for batch in batches(rows):
            ids = [np.concatenate([a, end]) for a in encoder(tokenizer, space=False).column(batch.column(1))]
            if any(int(a.max()) >> (8 * width) for a in ids):
                raise ValueError(f"a token id does not fit into {width} bytes")
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    batch.column(3),
                    pa.array([len(a) for a in ids], pa.int64()),
                    pa.array([a.astype(f"<u{width}").tobytes() for a in ids], pa.binary()),
                ],
                ["doc_id", "source", "deal", "n", "ids"],
            )

    rows = texts(docs, "source").select(
        "doc_id",
        "text",
        F.col("source").cast("string").alias("source"),
        F.xxhash64("doc_id", F.monotonically_increasing_id()).alias("deal"),
    )
    return written(rows.mapInArrow(encode, ENCODED), "packing-ids")


def windows(total: int, length: int) -> list[int]:
    """Window lengths for ``total`` ids: full ones, then the rest as falling powers of two."""
    full, rest = divmod(total, length)
    return [length] * full + [1 << k for k in reversed(range(rest.bit_length())) if rest >> k & 1]


class Queue:
    def __init__(self, share: float, deficit: float):
        self.share, self.deficit = share, deficit
        self.docs: deque[tuple[int, np.ndarray]] = deque()
        self.at = 0  # ids of the first document that are packed already


def pack(queues: list[Queue], length: int, least: int) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Pieces as (row, start, length, window, offset, queue) of one bucket."""
    total = sum(len(ids) for q in queues for _, ids in q.docs)
    turn = 0
    for window, size in enumerate(windows(total, length)):
        filled = 0
        for q in queues:
            q.deficit += q.share * size
        pieces = []

        def take(k: int, most: int) -> int:
            q = queues[k]
            row, ids = q.docs[0]
            n = min(most, len(ids) - q.at, size - filled)
            pieces.append((row, q.at, n, window, filled, k))
            q.deficit -= n
            q.at += n
            if q.at == len(ids):
                q.docs.popleft()
                q.at = 0
            return n

        for step in range(len(queues)):
            k = (turn + step) % len(queues)
            q = queues[k]
            while q.docs and filled < size:
                left, credit = len(q.docs[0][1]) - q.at, math.floor(q.deficit)
                if credit < min(left, least) or credit < 1:
                    break
                filled += take(k, credit)
        turn = (turn + 1) % len(queues)
        while filled < size:  # room nobody has credit for
            k = max((k for k, q in enumerate(queues) if q.docs), key=lambda k: queues[k].deficit)
            filled += take(k, size)
        yield from pieces


def packed(
    docs: DataFrame, tokenizer: str, *, length: int = 4096, end_id: int = 2, width: int = 2, least: int = 256,
    targets: Mapping[str | None, float] | None = None, bucket_ids: int = BUCKET_IDS, with_ids: bool = True,
) -> DataFrame:
    """One row per piece of a document in a sequence; ``ids`` holds its ids, ``width`` bytes each."""
    rows = encoded(docs, tokenizer, end_id, width)
    total = rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    buckets = max(1, math.ceil(total / bucket_ids))
    rows = rows.withColumn("bucket", F.pmod("deal", F.lit(buckets)))
    starts = carried(rows.groupBy("bucket", "source").agg(F.sum("n").alias("n")), total, targets)
    starts = starts.toDF(*starts.columns)  # columns of its own beside those it was counted from

    def pack_bucket(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        right = right.sort_values("source", na_position="first", kind="stable")
        names = [s if isinstance(s, str) else None for s in right["source"]]
        queues = [Queue(share, deficit) for share, deficit in zip(right["share"], right["deficit"])]
        of = {name: queue for name, queue in zip(names, queues)}
        left = left.sort_values(["deal", "doc_id"], kind="stable")
        doc_ids, sources = left["doc_id"].tolist(), [s if isinstance(s, str) else None for s in left["source"]]
        arrays = [np.frombuffer(b, f"<u{width}") for b in left["ids"]]
        for row, ids in enumerate(arrays):
            of[sources[row]].docs.append((row, ids))
        out = []
        for row, start, n, window, offset, _ in pack(queues, length, least):
            ids = arrays[row][start : start + n]
            out.append((
                doc_ids[row], sources[row], start, n, zlib.crc32(ids.astype("<u4")), len(arrays[row]),
                (int(key[0]) << 32) + window, offset, ids.tobytes() if with_ids else None,
            ))
        made = pd.DataFrame(out, columns=[c.split()[0] for c in PIECES.split(", ")])
        made["doc_id"] = made["doc_id"].astype("Int64")
        return made

    pieces = rows.groupBy("bucket").cogroup(starts.groupBy("bucket")).applyInPandas(pack_bucket, PIECES)
    return pieces if with_ids else pieces.drop("ids")


def before(counts: DataFrame, name: str) -> DataFrame:
    """For each bucket and key the sum of ``n`` over the key's smaller buckets, as column ``name``.

    The sums run over groups of buckets first, so that no task has to go through all buckets.
    """
    counts = counts.withColumn("part", F.floor(F.col("bucket") / GROUP))
    back = (Window.unboundedPreceding, -1)
    parts = counts.groupBy("key", "part").agg(F.sum("n").alias("n"))
    over = Window.partitionBy("key").orderBy("part").rowsBetween(*back)
    parts = parts.select("key", "part", F.coalesce(F.sum("n").over(over), F.lit(0)).alias("whole_parts"))
    over = Window.partitionBy("key", "part").orderBy("bucket").rowsBetween(*back)
    inside = F.coalesce(F.sum("n").over(over), F.lit(0))
    within = counts.select("key", "part", "bucket", inside.alias("inside"))
    sums = within.join(parts, ["key", "part"])
    return sums.select("key", "bucket", (F.col("whole_parts") + F.col("inside")).alias(name))


def carried(counts: DataFrame, total: int, targets: Mapping[str | None, float] | None) -> DataFrame:
    """bucket, source, share and the deficit with which each source of a bucket starts.

    counts: bucket, source, n. The deficit is the source's share of all ids in earlier buckets less
    its own ids there.
    """
    counts = counts.withColumn("key", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")))
    if targets is None:
        shares = counts.groupBy("key").agg((F.sum("n") / F.lit(float(max(total, 1)))).alias("share"))
    else:
        whole = float(sum(targets.values()))
        share = F.lit(0.0)
        for name, value in targets.items():
            share = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(value / whole)).otherwise(share)
        shares = counts.groupBy("key").agg(F.max(share).alias("share"))
    everything = counts.groupBy("bucket").agg(F.sum("n").alias("n")).withColumn("key", F.lit(""))
    so_far = before(everything, "all_before").drop("key")
    rows = counts.join(before(counts, "own_before"), ["key", "bucket"]).join(so_far, "bucket").join(shares, "key")
    deficit = F.col("share") * F.col("all_before") - F.col("own_before")
    return rows.select("bucket", "source", "share", deficit.alias("deficit"))
