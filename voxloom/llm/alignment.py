"""Alignment of two tokenizers' token ids over a corpus, with an identity-map fast path.

Tokenizer A (byte-level BPE) reads a space and the text, tokenizer B (sentencepiece, which adds the
space itself) the text. Both id sequences cover the same bytes; offsets at which tokens of both end cut
them into groups. The last tokens of a group end together: they are linked. A group of one token on
each side holds the same bytes on both, so its link is known from the A id alone by a map made once from
the two vocabularies. Such links are counted in vectors as long as the vocabulary, one per task; only
links of other groups go through a shuffle of pairs, summed up in their task before.

What the tasks are sent is bounded by the vocabularies (the counts of mapped links, the highest count
of each B id) and by ``hot_pairs``, the number of most frequent other pairs whose counts are sent along.
Links of rarer pairs are joined to their counts; no such pair has more than 2 / ``hot_pairs`` of all links.

Cases: null and empty texts, and texts of which either tokenizer changes a byte, have no tokens: zeros
and an empty digest; strings of special tokens in a text are ordinary text; rows that share a doc_id, or
have none, are documents of their own and all count; an empty table gives no row; columns other than
doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm.common import Pieces, WordEncoder, batches, texts, worker_memo, written

SLICE_BYTES = 1 << 20  # text aligned together in a task
FLUSH = 1 << 21  # pairs summed up together in a task
ROWS = (
    "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "same binary, pairs binary, times binary"
)
PAIRS = "a int, b int, n long"
PARTS = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


# ---- vocabularies ------------------------------------------------------------------------------------
def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level BPE vocabularies, and back."""
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


def bytes_of_a(path: str) -> list[bytes]:
    """The bytes of every id of a byte-level BPE file; ids of special tokens, which no text gets, have none."""
    with open(path, encoding="utf-8") as file:
        made = json.load(file)
    letters, special = byte_letters(), {t["id"] for t in made["added_tokens"]}
    out = [b""] * (1 + max(max(made["model"]["vocab"].values()), *special, 0))
    for token, i in made["model"]["vocab"].items():
        if i not in special:
            out[i] = bytes(letters[c] for c in token)
    return out


def bytes_of_b(path: str) -> list[bytes]:
    """The bytes of every id of a sentencepiece file; unknown and control ids have none."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    plain = lambda i: b"" if model.is_control(i) or model.is_unknown(i) else model.id_to_piece(i).replace("▁", " ").encode()
    return [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else plain(i) for i in range(model.get_piece_size())]


def identity_map(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """For every A id the last B id of the same bytes (whole pieces follow single bytes), -1 for none."""
    of = {piece: i for i, piece in enumerate(b) if piece}
    return np.array([of.get(piece, -1) for piece in a], np.int64)


class PieceWords:
    """Ids of whole texts by sentencepiece, each distinct word encoded once.

    No piece holds a space behind another character, or a line end beside one, so the ids of the pieces
    between such places are the ids of the text; the constructor checks that of the vocabulary. Texts
    with two white spaces in a row are encoded whole. The memo is emptied at ``most`` words.
    """

    def __init__(self, path: str, most: int = 200_000):
        from sentencepiece import SentencePieceProcessor

        self.model, self.most = SentencePieceProcessor(model_file=path), most
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any("▁" in p.lstrip("▁") or "\n" in p and len(p) > 1 for p in pieces):
            raise ValueError("a piece of this vocabulary reaches from one word into the next")
        self.space = self.model.piece_to_id("▁")
        self.known: dict[str, int] = {}
        self.memo = Pieces()

    def column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and how many each text has."""
        whole = pc.match_substring_regex(texts, WordEncoder.SPACES).to_numpy(zero_copy_only=False)
        whole |= pc.match_substring_regex(texts, r"^[\s\x{2581}]").to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        ends = lists.offsets.to_numpy()[1:] - lists.offsets[0].as_py()
        heads = np.concatenate([[0], ends[:-1]])
        words = lists.flatten().dictionary_encode()
        order = self._words(words.dictionary.to_pylist())[words.indices.to_numpy()]
        ids, before = self.memo.gather(order)
        parts = np.split(ids, before[ends[:-1]]) if len(ends) > 1 else [ids]
        for k in np.flatnonzero(whole):
            parts[k] = np.array(self.model.encode(texts[int(k)].as_py(), num_threads=1), np.int64)
        if not whole.any():
            return ids, before[ends] - before[heads]
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)

    def _words(self, words: list[str]) -> np.ndarray:
        known = self.known
        new = [w for w in words if w not in known]
        if len(known) + len(new) > self.most:
            known.clear()
            self.memo, new = Pieces(), words
        if new:
            found = self.model.encode(new, num_threads=1)
            # A word behind a line end has no space: the one that the model puts first stands alone there.
            found = [f[1:] if w[:1] == "\n" else f if w else [self.space] for w, f in zip(new, found)]
            ids = np.fromiter((i for f in found for i in f), np.int64)
            first = self.memo.add(ids, np.array([len(f) for f in found], np.int64))
            known.update(zip(new, range(first, first + len(new))))
        self.memo.pack()
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))


# ---- one slice of texts --------------------------------------------------------------------------------
@dataclass
class Vocabulary:
    """What a task knows of one side: token lengths, bytes, and decimal ids with each separator."""

    lengths: np.ndarray
    pieces: pa.Array
    shown: pa.Array

    @classmethod
    def of(cls, pieces: list[bytes], end: str) -> "Vocabulary":
        shown = pa.array([f"{i}{sep}" for sep in (",", end) for i in range(len(pieces))], pa.large_binary())
        return cls(np.array([len(p) for p in pieces], np.int64), pa.array(pieces, pa.large_binary()), shown)


class Aligner:
    def __init__(self, path_a: str, path_b: str):
        a, b = bytes_of_a(path_a), bytes_of_b(path_b)
        self.a, self.b = Vocabulary.of(a, "|"), Vocabulary.of(b, ";")
        self.shown = pa.concat_arrays([self.a.shown, self.b.shown])
        self.of = identity_map(a, b)
        self.words_a, self.words_b = WordEncoder(path_a, space=True, most=300_000), PieceWords(path_b)

    def align(self, texts: pa.Array) -> Iterator[tuple[int, int, int, str, np.ndarray, np.ndarray]]:
        """n_a, n_b, n_groups, digest, A ids of mapped links, codes of other links for every text."""
        read = pc.binary_join_element_wise("", texts, " ")
        found = list(self.words_a.column(read))
        a, n_a = np.concatenate(found).astype(np.int64), np.array([len(f) for f in found], np.int64)
        b, n_b = self.words_b.column(texts)
        sizes = pc.binary_length(read).to_numpy(zero_copy_only=False).astype(np.int64)
        kept = np.flatnonzero((sizes > 1) & self.same(a, n_a, read, self.a) & self.same(b, n_b, read, self.b))
        none = np.zeros(0, np.int64)
        if not len(kept):
            yield from [(0, 0, 0, "", none, none)] * len(texts)
            return
        if len(kept) < len(texts):
            stays = np.isin(np.arange(len(texts)), kept)
            a, b = a[np.repeat(stays, n_a)], b[np.repeat(stays, n_b)]
            n_a, n_b = n_a[kept], n_b[kept]
        end_a, end_b = np.cumsum(self.a.lengths[a]), np.cumsum(self.b.lengths[b])
        cuts = np.intersect1d(end_a, end_b, assume_unique=True)
        last_a, last_b = np.searchsorted(end_a, cuts), np.searchsorted(end_b, cuts)
        group_a, group_b = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
        # Tokens of a group lie side by side, those of A first.
        shown = np.empty(len(a) + len(b), np.int64)
        before_b = np.concatenate([[0], last_b + 1])
        place_a = np.arange(len(a)) + before_b[group_a]
        place_b = np.arange(len(b)) + (last_a + 1)[group_b]
        wide_a, wide_b = len(self.a.lengths), len(self.b.lengths)
        at_end_a, at_end_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        at_end_a[last_a], at_end_b[last_b] = True, True
        shown[place_a] = a + wide_a * at_end_a
        shown[place_b] = 2 * wide_a + b + wide_b * at_end_b
        text = self.shown.take(pa.array(shown))
        data, offsets = text.buffers()[2], np.frombuffer(text.buffers()[1], np.int64)[text.offset :]
        first_a, first_b = a[last_a], b[last_b]
        single = (np.diff(last_a, prepend=-1) == 1) & (np.diff(last_b, prepend=-1) == 1) & (self.of[first_a] == first_b)
        codes = np.where(single, -1, first_a * wide_b + first_b)
        stops_a, stops_b = np.cumsum(n_a), np.cumsum(n_b)
        stops_g = np.searchsorted(last_a, stops_a)  # every text ends with a group
        row = dict(zip(kept.tolist(), range(len(kept))))
        for k in range(len(texts)):
            if k not in row:
                yield 0, 0, 0, "", none, none
                continue
            i = row[k]
            g0, g1 = (int(stops_g[i - 1]) if i else 0), int(stops_g[i])
            t0, t1 = (int(stops_a[i - 1] + stops_b[i - 1]) if i else 0), int(stops_a[i] + stops_b[i])
            digest = hashlib.sha256(memoryview(data)[offsets[t0] : offsets[t1] - 1]).hexdigest()
            one, code = single[g0:g1], codes[g0:g1]
            yield int(n_a[i]), int(n_b[i]), g1 - g0, digest, first_a[g0:g1][one], code[~one]

    @staticmethod
    def same(ids: np.ndarray, n: np.ndarray, read: pa.Array, side: Vocabulary) -> np.ndarray:
        """For every text whether its tokens' bytes are its own."""
        if not len(ids):
            return np.zeros(len(n), bool)
        made = side.pieces.take(pa.array(ids))
        offsets = np.frombuffer(made.buffers()[1], np.int64)[made.offset : made.offset + len(ids) + 1]
        stops = np.concatenate([[0], np.cumsum(n)])
        data = memoryview(made.buffers()[2] or b"")
        return np.array([
            data[offsets[i] : offsets[j]] == memoryview(t.as_buffer()) for i, j, t in zip(stops[:-1], stops[1:], read.cast(pa.binary()))
        ], bool)


def slices(rows: Iterator[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
    """Batches of at most 256 rows and, if they have more than one, about SLICE_BYTES of text."""
    for batch in batches(rows):
        sizes = np.cumsum(pc.binary_length(batch.column(at)).to_numpy(zero_copy_only=False))
        first = 0
        while first < batch.num_rows:
            done = sizes[first - 1] if first else 0
            stop = max(first + 1, int(np.searchsorted(sizes, done + SLICE_BYTES, "right")))
            yield batch.slice(first, stop - first)
            first = stop


# ---- the corpus ----------------------------------------------------------------------------------------
def groups_of(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """A row per document: its counts and digest, A ids of mapped links, other links with their number."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = worker_memo(f"aligner:{path_a}:{path_b}", lambda: Aligner(path_a, path_b))
        row = TaskContext.get().partitionId() << 40
        names = [c.split()[0] for c in ROWS.split(", ")]
        kinds = [pa.int64()] * 6 + [pa.string()] + [pa.binary()] * 3
        for batch in slices(rows, 1):
            out = []
            for doc_id, (n_a, n_b, n, digest, same, codes) in zip(batch.column(0).to_pylist(), aligner.align(batch.column(1))):
                pairs, times = np.unique(codes, return_counts=True)
                out.append((row, doc_id, n_a, n_b, n, n, digest, same.astype("<u4").tobytes(), pairs.astype("<i8").tobytes(), times.astype("<u4").tobytes()))
                row += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)
        pa.default_memory_pool().release_unused()  # the worker lives on, for other tasks

    return texts(docs).mapInArrow(run, ROWS)


def pair_counts(groups: DataFrame, of: np.ndarray, wide_b: int) -> DataFrame:
    """a, b, n: how many links of the corpus hold each pair of ids linked."""
    sent = groups.sparkSession.sparkContext.broadcast(of)  # as long as A's vocabulary

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, codes, times, held = sent.value, [], [], 0
        mapped = np.zeros(len(of), np.int64)

        def sums() -> pa.RecordBatch:
            code, at = np.unique(np.concatenate(codes), return_inverse=True)
            n = np.bincount(at, np.concatenate(times), len(code)).astype(np.int64)
            return as_rows(code // wide_b, code % wide_b, n)

        for batch in batches(rows):
            same, pairs, n = (b"".join(batch.column(k).to_pylist()) for k in range(3))
            mapped += np.bincount(np.frombuffer(same, "<u4"), minlength=len(of))
            codes.append(np.frombuffer(pairs, "<i8"))
            times.append(np.frombuffer(n, "<u4"))
            held += len(codes[-1])
            if held > FLUSH:
                yield sums()
                codes, times, held = [], [], 0
        if held:
            yield sums()
        a = np.flatnonzero(mapped)
        yield as_rows(a, of[a], mapped[a])

    def as_rows(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(n, pa.int64())], ["a", "b", "n"])

    return groups.select("same", "pairs", "times").mapInArrow(count, PAIRS).groupBy("a", "b").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, most: int) -> DataFrame:
    """The rows with the highest n, by powers of two: as many as ``most`` allows, without a sort."""
    bits = F.length(F.bin("n")).alias("bits")
    sizes = sorted(counts.groupBy(bits).count().collect(), reverse=True)  # at most 63 rows
    least, held = 64, 0
    for size, rows in sizes:
        held += rows
        if held > most:
            break
        least = size
    return counts.where(bits >= least)


def aligned(docs: DataFrame, path_a: str, path_b: str, *, hot_pairs: int = 1 << 17) -> tuple[DataFrame, DataFrame]:
    """One row per document, and the counts a, b, n of all linked id pairs.

    Documents: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose count is the highest of their B
    id), count_sum (sum of the links' counts), groups_sha256.
    """
    spark = docs.sparkSession
    bytes_a, bytes_b = bytes_of_a(path_a), bytes_of_b(path_b)
    of, wide_b = identity_map(bytes_a, bytes_b), len(bytes_b)
    groups = written(groups_of(docs, path_a, path_b), "alignment-groups")
    counts = written(pair_counts(groups, of, wide_b), "alignment-pairs")
    best, mapped = np.zeros(wide_b, np.int64), np.zeros(len(of), np.int64)
    for b, n in counts.groupBy("b").agg(F.max("n")).toLocalIterator():  # at most B's vocabulary
        best[b] = n
    pairs_of_map = spark.createDataFrame([(int(a), int(b)) for a, b in enumerate(of) if b >= 0], "a int, b int")
    own = counts.join(F.broadcast(pairs_of_map), ["a", "b"], "left_semi").select("a", "n")
    for a, n in own.toLocalIterator():  # at most A's vocabulary
        mapped[a] = n
    code = (F.col("a").cast("long") * wide_b + F.col("b")).alias("code")
    others = counts.join(F.broadcast(pairs_of_map), ["a", "b"], "left_anti").select(code, "n", "b")
    top = frequent(others, hot_pairs).select("code", "n").toArrow().sort_by("code")  # at most hot_pairs rows
    hot, hot_n = top["code"].to_numpy(), top["n"].to_numpy()
    sent = spark.sparkContext.broadcast((of, best, mapped, hot, hot_n))

    def finish(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, best, mapped, hot, hot_n = sent.value
        highest = mapped == best[of]
        kinds = [pa.int64()] * 8 + [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        names = [c.split()[0] for c in PARTS.split(", ")] + ["rest", "rest_n"]
        for batch in batches(rows):
            columns = [batch.column(k) for k in range(7)]
            out = []
            for same, pairs, times in zip(*(batch.column(k).to_pylist() for k in (7, 8, 9))):
                same, pairs, times = np.frombuffer(same, "<u4"), np.frombuffer(pairs, "<i8"), np.frombuffer(times, "<u4").astype(np.int64)
                at = np.minimum(np.searchsorted(hot, pairs), max(len(hot) - 1, 0))
                there = hot[at] == pairs if len(hot) else np.zeros(len(pairs), bool)
                n, t = hot_n[at[there]], times[there]
                n_best = int(highest[same].sum() + t[n == best[pairs[there] % wide_b]].sum())
                out.append((n_best, int(mapped[same].sum() + (n * t).sum()), pairs[~there].tolist(), times[~there].tolist()))
            made = list(zip(*out))
            arrays = [*columns[:6], *(pa.array(c, t) for c, t in zip(made[:2], kinds[6:8])), columns[6], *(pa.array(c, kinds[-1]) for c in made[2:])]
            yield pa.RecordBatch.from_arrays(arrays, names)

    parts = written(groups.mapInArrow(finish, PARTS + ", rest array<long>, rest_n array<long>"), "alignment-parts")
    rest = parts.where(F.size("rest") > 0).select("row", F.explode(F.arrays_zip("rest", "rest_n")).alias("p"))
    rest = rest.select("row", F.col("p.rest").alias("code"), F.col("p.rest_n").alias("times"))
    highest = F.broadcast(spark.createDataFrame([(b, int(n)) for b, n in enumerate(best) if n], "b int, highest long"))
    rest = rest.join(others.join(highest, "b"), "code").groupBy("row").agg(
        F.sum(F.when(F.col("n") == F.col("highest"), F.col("times")).otherwise(0)).alias("more_best"),
        F.sum(F.col("n") * F.col("times")).alias("more_sum"),
    )
    plus = lambda name, more: (F.col(name) + F.coalesce(F.col(more), F.lit(0))).cast("long").alias(name)
    done = parts.drop("rest", "rest_n").join(rest, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", plus("n_best", "more_best"), plus("count_sum", "more_sum"), "groups_sha256"
    )
    return done, counts
