"""What the corpus operators share: columns, worker memos, tokenizers and scratch tables."""

from __future__ import annotations

import os
import re
import sys
import types
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from voxloom.session import scratch_path

WORKER = "_voxloom_worker_memo"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id as long, text as string (null: empty) and the columns named, nothing else."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *[F.col(c) for c in more],
    )


def held_out(doc_id: str = "doc_id") -> F.Column:
    """crc32 of the id's digits leaves remainder 1: such rows are never learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def written(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """The rows as a Parquet table in the shared folder: a plan ends here and is never run twice."""
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing will read again."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def worker_memo(key: str, make: Callable[[], object]) -> object:
    """One object per Python worker, made on first use and kept for the worker's later tasks."""
    memo = sys.modules.setdefault(WORKER, types.ModuleType(WORKER))
    if not hasattr(memo, key):
        setattr(memo, key, make())
    return getattr(memo, key)


def batches(rows: Iterable[pa.RecordBatch], limit: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of at most ``limit``, so that long texts never pile up as objects."""
    for batch in rows:
        for at in range(0, batch.num_rows, limit):
            yield batch.slice(at, limit)


def with_text_column(
    df: DataFrame, into: str, ddl: str, start: Callable[[], Callable[[pa.Array], list]], text: str = "text"
) -> DataFrame:
    """All rows and columns of ``df`` plus the column ``into``, computed from whole texts in the tasks.

    ``start`` runs once per task and returns a function from an Arrow column of texts (null: empty) to
    one Python value per text.
    """
    if into in df.columns:
        raise ValueError(f"there is a column {into} already")
    kind = T.StructType.fromDDL(f"made {ddl}")[0].dataType
    schema = T.StructType([*df.schema.fields, T.StructField(into, kind)])
    at, arrow = df.columns.index(text), to_arrow_type(kind)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = start()
        for batch in batches(rows):
            made = compute(pc.fill_null(batch.column(at).cast(pa.string()), ""))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, arrow)], [*batch.schema.names, into])
        pa.default_memory_pool().release_unused()  # the worker lives on, for other tasks

    return df.mapInArrow(run, schema)


class Pieces:
    """Token ids of pieces of text, end to end, gathered in any order."""

    def __init__(self):
        self.ids: list[np.ndarray] = []
        self.lengths: list[np.ndarray] = []
        self.n = 0

    def add(self, ids: np.ndarray, lengths: np.ndarray) -> int:
        """The number of the first piece added."""
        self.ids.append(ids)
        self.lengths.append(lengths)
        self.n += len(lengths)
        return self.n - len(lengths)

    def pack(self) -> None:
        self.ids = [np.concatenate(self.ids)] if self.ids else []
        self.lengths = [np.concatenate(self.lengths)] if self.lengths else []

    def gather(self, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces in this order, and how many ids lie before each piece and the end."""
        ids, lengths = np.concatenate(self.ids), np.concatenate(self.lengths)
        starts = np.cumsum(lengths) - lengths
        taken = lengths[order]
        before = np.concatenate([[0], np.cumsum(taken)])
        places = np.repeat(starts[order] - before[:-1], taken) + np.arange(before[-1])
        return ids[places], before


class WordEncoder:
    """Token ids of whole texts by the tokenizers library, each distinct word of a batch encoded once.

    A text is cut only where the tokenizer itself always cuts, so the ids of the pieces in a row are the
    ids of the text: at any space where white space is dropped (``space`` false); else, as the space
    then belongs to the word after it, at single spaces between visible characters. Letters are cut
    from the marks behind them, so that they are encoded once for all marks; new words of letters are
    encoded together, as one text of words, and remembered. The memo is emptied at ``most`` words.
    """

    SPACES = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]{2}"
    LETTERS = r"^[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}]+$"
    MARKS = ".,!?;:*$%&#)"

    def __init__(self, path: str, space: bool, batch_bytes: int = 16 << 20, most: int = 700_000, special: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a word are ordinary text
        names = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if special else []
        self.special = "|".join(re.escape(n) for n in names)
        self.start = os.path.commonprefix(names)  # a fast search, as hardly any text has it
        self.space, self.batch_bytes, self.most = space, batch_bytes, most
        self.known: dict[str, int] = {}  # words of letters and their pieces in the memo
        self.memo = Pieces()

    def column(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text of an Arrow string column without nulls."""
        held = self._with_special(texts)
        if not held:
            yield from self._plain_column(texts)
            return
        at = 0
        for k in held:
            yield from self._plain_column(texts.slice(at, k - at))
            self.tokenizer.encode_special_tokens = False
            ids = self.tokenizer.encode(texts[k].as_py(), add_special_tokens=False).ids
            self.tokenizer.encode_special_tokens = True
            yield np.array(ids, np.uint32)
            at = k + 1
        yield from self._plain_column(texts.slice(at))

    def _with_special(self, texts: pa.Array) -> list[int]:
        if not self.special:
            return []
        near = np.flatnonzero(pc.match_substring(texts, self.start).to_numpy(zero_copy_only=False))
        return [int(k) for k in near if re.search(self.special, texts[int(k)].as_py())]

    def _plain_column(self, texts: pa.Array) -> Iterator[np.ndarray]:
        if not self.space:  # such a vocabulary is also one of lower-case words, and a line end is a space
            texts = pc.replace_substring(pc.ascii_lower(texts), "\n", " ")
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(texts):
            done = sizes[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(sizes, done + self.batch_bytes, "right")))
            yield from self._some(texts.slice(at, stop - at))
            at = stop

    def _some(self, texts: pa.Array) -> Iterator[np.ndarray]:
        pieces = Pieces()
        # A single line end also is a cut: it stands alone, and the word after it has no space.
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " \n") if self.space else texts, " ")
        ends = lists.offsets.to_numpy()[1:] - lists.offsets[0].as_py()
        heads = np.concatenate([[0], ends[:-1]])
        words = lists.flatten().dictionary_encode()
        order = self._words(words.dictionary, pieces)[words.indices.to_numpy()]
        if self.space:  # the first word of a text has no space before it
            order[heads, 0] = self._plain(words.dictionary.take(words.indices.take(pa.array(heads))).to_pylist(), pieces)
            order[heads, 1:] = pieces.add(np.zeros(0, np.uint32), np.zeros(1, np.int64))
        ids, before = pieces.gather(order.ravel())
        bounds = before[np.concatenate([[0], ends]) * order.shape[1]]
        apart = pc.match_substring_regex(texts, self.SPACES).to_numpy(zero_copy_only=False) if self.space else None
        for k in range(len(texts)):
            if self.space and apart[k]:
                yield np.array(self.tokenizer.encode(texts[k].as_py(), add_special_tokens=False).ids, np.uint32)
            else:
                yield ids[bounds[k] : bounds[k + 1]]

    def _plain(self, words: list[str], pieces: Pieces) -> np.ndarray:
        found = [e.ids for e in self.tokenizer.encode_batch(words, add_special_tokens=False)]
        ids = np.fromiter((i for f in found for i in f), np.uint32)
        first = pieces.add(ids, np.array([len(f) for f in found], np.int64))
        return first + np.arange(len(words))

    def _words(self, words: pa.Array, pieces: Pieces) -> np.ndarray:
        """For each word the numbers of three pieces: letters, marks and a line end before them, or the
        whole word; what is missing is an empty piece."""
        nothing = pieces.add(np.zeros(0, np.uint32), np.zeros(1, np.int64))
        out = np.full((len(words), 3), nothing)
        lines = pc.starts_with(words, "\n").to_numpy(zero_copy_only=False) & self.space
        if lines.any():
            at = np.flatnonzero(lines)
            after = pc.utf8_slice_codeunits(words.take(pa.array(at)), 1).dictionary_encode()
            out[at, 0] = self._plain(["\n"], pieces)
            out[at, 1:] = self._parts(after.dictionary, pieces, "", nothing)[after.indices.to_numpy()]
        at = np.flatnonzero(~lines)
        out[at, :2] = self._parts(words.take(pa.array(at)), pieces, " " if self.space else "", nothing)
        return out

    def _parts(self, words: pa.Array, pieces: Pieces, before: str, nothing: int) -> np.ndarray:
        """Letters and marks, or the whole word and nothing."""
        out = np.full((len(words), 2), nothing)
        cores = pc.utf8_rtrim(words, self.MARKS)
        plain = pc.match_substring_regex(cores, self.LETTERS).to_numpy(zero_copy_only=False)
        other = np.flatnonzero(~plain)
        out[other, 0] = self._plain([before + w for w in words.take(pa.array(other)).to_pylist()], pieces)
        letters = np.flatnonzero(plain)
        marked = np.flatnonzero(plain & pc.less(pc.binary_length(cores), pc.binary_length(words)).to_numpy(zero_copy_only=False))
        cores = cores.take(pa.array(letters)).dictionary_encode()
        out[letters, 0] = self._together(cores.dictionary.to_pylist(), pieces, before)[cores.indices.to_numpy()]
        marks = pc.replace_substring_regex(words.take(pa.array(marked)), r"^[^.,!?;:*$%&#)]+", "").dictionary_encode()
        out[marked, 1] = self._plain(marks.dictionary.to_pylist(), pieces)[marks.indices.to_numpy()]
        return out

    def _together(self, words: list[str], pieces: Pieces, before: str) -> np.ndarray:
        """Words of Latin letters only, from the memo of earlier batches where it has them."""
        if self.space and not before:  # few: the first words of lines
            return self._plain(words, pieces)
        known = self.known
        new = [w for w in words if w not in known]
        if len(known) + len(new) > self.most:
            known.clear()
            self.memo, new = Pieces(), words
        if new:
            ids, lengths = self._encoded(new)
            first = self.memo.add(ids, lengths)
            known.update(zip(new, range(first, first + len(new))))
        self.memo.pack()
        first = pieces.n
        for ids, lengths in zip(self.memo.ids, self.memo.lengths):
            pieces.add(ids, lengths)
        return first + np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Each of the words is one piece of the text they make."""
        lengths, ids = [], []
        for at in range(0, len(words), 1000):
            some = words[at : at + 1000]
            found = self.tokenizer.encode((" " if self.space else "") + " ".join(some), add_special_tokens=False)
            lengths.append(np.bincount(np.array(found.word_ids, np.int64)))
            ids.append(np.array(found.ids, np.uint32))
            if len(lengths[-1]) != len(some):
                raise ValueError("the tokenizer cuts inside a word of letters")
        return np.concatenate(ids), np.concatenate(lengths)


def encoder(path: str, space: bool) -> WordEncoder:
    return worker_memo(f"encoder:{path}", lambda: WordEncoder(path, space, special=True))
