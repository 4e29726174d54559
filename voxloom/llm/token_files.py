"""Token-id files with Elias-Fano document boundaries.

``write_token_files`` encodes every text and lays the ids of all documents end to end, in ascending
doc_id order, in segments of about a million ids. A segment is one row of a Parquet table in a shared
folder, so Spark's own commit protocol makes it safe against lost executors and any store can hold it:

    part, seq   place of the segment in the order
    n_docs, n_ids
    width, ids  the ids, little-endian, 2 or 4 bytes each
    bounds      Elias-Fano code of the n_docs + 1 document boundaries inside the segment
    no_id, base, doc_ids  leading documents without doc_id; Elias-Fano code of the others' doc_id - base

Cases: null and empty texts are documents of the end id alone; rows that share a doc_id follow each
other, ordered by a hash of the text; a null doc_id comes first; an empty table gives an empty file.
Columns other than doc_id and text are ignored.
A special token's string in a text becomes that token, as the library's plain call has it.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxloom.llm.common import batches, encoder, texts

SEGMENT_IDS = 1 << 20
BLOCK = 512  # bits of the upper half that share one stored rank
HEAD = "<QBQ"

SEGMENT_SCHEMA = (
    "part int, seq int, n_docs long, n_ids long, width int, ids binary, bounds binary, "
    "no_id long, base long, doc_ids binary"
)
DOCUMENT_SCHEMA = "part int, seq int, doc_id long, start_in_segment long, n_tokens long, ids_crc32 long"


class EliasFano:
    """A rising sequence in near-minimal space: low bits packed, high bits in unary with sampled ranks."""

    def __init__(self, n: int, low_bits: int, lows: np.ndarray, highs: np.ndarray, ranks: np.ndarray):
        self.n, self.low_bits, self.lows, self.highs, self.ranks = n, low_bits, lows, highs, ranks

    @classmethod
    def encode(cls, values: np.ndarray) -> "EliasFano":
        values = np.asarray(values, np.uint64)
        n = len(values)
        if not n:
            return cls(0, 0, np.zeros(0, np.uint8), np.zeros(0, np.uint8), np.zeros(0, np.uint32))
        low_bits = max(0, (int(values[-1]) // n).bit_length() - 1)
        bits = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        lows = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little")
        at = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        upper = np.zeros((int(at[-1]) // BLOCK + 1) * BLOCK, np.uint8)
        upper[at] = 1
        ranks = np.concatenate([[0], np.cumsum(upper.reshape(-1, BLOCK).sum(1))[:-1]]).astype(np.uint32)
        return cls(n, low_bits, lows, np.packbits(upper, bitorder="little"), ranks)

    def select(self, i: int) -> int:
        """The i-th value, by one block of the upper half and its own low bits."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        block = int(np.searchsorted(self.ranks, i, "right")) - 1
        piece = self.highs[block * BLOCK // 8 : (block + 1) * BLOCK // 8]
        ones = np.flatnonzero(np.unpackbits(piece, bitorder="little"))
        high = block * BLOCK + int(ones[i - int(self.ranks[block])]) - i
        first, last = i * self.low_bits, (i + 1) * self.low_bits
        packed = np.unpackbits(self.lows[first // 8 : (last + 7) // 8], bitorder="little")
        low = packed[first % 8 : first % 8 + self.low_bits]
        return (high << self.low_bits) | sum(int(bit) << k for k, bit in enumerate(low))

    def values(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.highs, bitorder="little"))
        result = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        bits = np.unpackbits(self.lows, count=self.n * self.low_bits, bitorder="little")
        for k in range(self.low_bits):
            result |= bits[k :: self.low_bits].astype(np.uint64) << np.uint64(k)
        return result

    def to_bytes(self) -> bytes:
        head = struct.pack(HEAD, self.n, self.low_bits, len(self.highs))
        return head + self.highs.tobytes() + self.ranks.astype("<u4").tobytes() + self.lows.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> "EliasFano":
        n, low_bits, size = struct.unpack_from(HEAD, data)
        at, blocks = struct.calcsize(HEAD), size * 8 // BLOCK
        highs = np.frombuffer(data, np.uint8, size, at)
        ranks = np.frombuffer(data, "<u4", blocks, at + size)
        return cls(n, low_bits, np.frombuffer(data, np.uint8, -1, at + size + 4 * blocks), highs, ranks)


def _segment(part: int, seq: int, doc_ids: list, arrays: list[np.ndarray], width: int) -> dict:
    no_id = sum(d is None for d in doc_ids)
    known = np.array([d for d in doc_ids if d is not None], np.int64)
    base = int(known[0]) if len(known) else 0
    bounds = np.concatenate([[0], np.cumsum([len(a) for a in arrays])])
    return {
        "part": part, "seq": seq, "n_docs": len(arrays), "n_ids": int(bounds[-1]), "width": width,
        "ids": np.concatenate(arrays).astype(f"<u{width}").tobytes(),
        "bounds": EliasFano.encode(bounds).to_bytes(), "no_id": no_id, "base": base,
        "doc_ids": EliasFano.encode(known.view(np.uint64) - np.int64(base).view(np.uint64)).to_bytes(),
    }


def _arrow(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [column.split() for column in SEGMENT_SCHEMA.split(", ")]
    return pa.RecordBatch.from_pylist(rows, pa.schema([(name, kinds[kind]) for name, kind in fields]))


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, *, end_id: int = 0, space: bool = True, width: int = 2,
    segment_ids: int = SEGMENT_IDS,
) -> None:
    """Encode doc_id, text and write the segments to ``path``; ``width`` 2 holds ids up to 65,535."""

    def encode(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, size = TaskContext.get().partitionId(), 0, 0
        doc_ids: list = []
        arrays: list[np.ndarray] = []
        end = np.array([end_id], "<u4")
        for batch in batches(rows):
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder(tokenizer, space).column(batch.column(1))):
                ids = np.concatenate([ids, end])
                if int(ids.max()) >> (8 * width):
                    raise ValueError(f"token id {int(ids.max())} does not fit into {width} bytes")
                doc_ids.append(doc_id)
                arrays.append(ids.astype(f"<u{width}"))
                size += len(ids)
                if size >= segment_ids:
                    yield _arrow([_segment(part, seq, doc_ids, arrays, width)])
                    seq, size, doc_ids, arrays = seq + 1, 0, [], []
        if arrays:
            yield _arrow([_segment(part, seq, doc_ids, arrays, width)])

    # The hash of the text also splits the rows of one doc_id, should it be in very many rows.
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    dealt = texts(docs).repartitionByRange(*order).sortWithinPartitions(*order)
    dealt.mapInArrow(encode, SEGMENT_SCHEMA).write.mode("overwrite").parquet(path)


def read_segment(row: dict) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """doc_id, start inside the segment and ids of every document of a segment."""
    bounds = EliasFano.from_bytes(row["bounds"]).values().astype(np.int64)
    ids = np.frombuffer(row["ids"], f"<u{row['width']}")
    base = np.int64(row["base"]).view(np.uint64)
    known = (EliasFano.from_bytes(row["doc_ids"]).values() + base).view(np.int64).tolist()
    for k, doc_id in enumerate([None] * row["no_id"] + known):
        yield doc_id, int(bounds[k]), ids[bounds[k] : bounds[k + 1]]


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    segments = spark.read.parquet(path)

    def decode(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows, 1):
            row = batch.to_pylist()[0]
            found = [
                (row["part"], row["seq"], doc_id, start, len(ids), zlib.crc32(ids.astype("<u4")))
                for doc_id, start, ids in read_segment(row)
            ]
            names = [c.split()[0] for c in DOCUMENT_SCHEMA.split(", ")]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), kinds)], names)

    parts = segments.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per task that wrote
    parts = parts.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("part_start"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        segments.select("part", "seq", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("seq_start"))
        .join(parts, "part")
        .select("part", "seq", (F.col("part_start") + F.col("seq_start")).alias("segment_start"))
    )
    documents = segments.mapInArrow(decode, DOCUMENT_SCHEMA).join(starts, ["part", "seq"])
    start = (F.col("segment_start") + F.col("start_in_segment")).alias("start")
    return documents.select("doc_id", start, "n_tokens", "ids_crc32")
