"""Benchmark decontamination with one Aho-Corasick automaton over normalised test items.

Words are runs of lower-cased ASCII letters, digits and non-ASCII characters. A window is ``window``
consecutive words of an item (all its words, if it has fewer). Every word of the benchmark is one symbol
of the automaton's alphabet and all other words are one symbol that no window holds, so each text is
scanned once, word by word. Hits are mapped back to code points of the original text.

The benchmark is cut into blocks of at most ``block_words`` window words. Each is one automaton of
bounded size, sent to the tasks, and the texts pass one block after the other within the same stage.

Cases: null and empty texts and items have no words; null item ids are ignored; repeated items and
windows count once per item id; an empty benchmark marks nothing; other columns are kept as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm.common import with_text_column

BLOCK_WORDS = 500_000
MARK = "struct<n_words long, n_hit long, items array<string>, spans array<struct<start long, stop long>>>"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
# Separators become spaces; A-Z are lowered before.
SEPARATED = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: str) -> list[bytes]:
    return text.encode("utf-8").lower().translate(SEPARATED).split()


def item_windows(text: str, window: int) -> set[tuple[bytes, ...]]:
    found = words(text)
    if len(found) < window:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + window]) for i in range(len(found) - window + 1)}


def blocks(items: DataFrame, window: int, block_words: int) -> Iterator[dict[tuple[bytes, ...], list[str]]]:
    """Windows with the ids of their items, at most about ``block_words`` words of them at a time."""
    rows = items.select(F.col("item_id").cast("string"), F.col("text").cast("string")).dropna()
    block: dict[tuple[bytes, ...], list[str]] = {}
    size = 0
    for item_id, text in rows.toLocalIterator():
        for key in item_windows(text, window):
            ids = block.setdefault(key, [])
            size += len(key) + 1
            if item_id not in ids:
                ids.append(item_id)
            if size >= block_words:
                yield block
                block, size = {}, 0
    if block:
        yield block


class Symbols(dict):
    """Benchmark words as single characters; any other word is the character that no window has."""

    def __missing__(self, word: bytes) -> str:
        return "\0"


class Scanner:
    def __init__(self, block: dict[tuple[bytes, ...], list[str]]):
        vocabulary = sorted({w for key in block for w in key})
        # Code points that are characters of their own: none of the surrogates.
        self.symbols = Symbols((w, chr(i + 1 if i < 0xD7FF else i + 0x801)) for i, w in enumerate(vocabulary))
        self.automaton = ahocorasick.Automaton()
        for key, ids in block.items():
            self.automaton.add_word("".join(self.symbols[w] for w in key), (len(key), ids))
        self.automaton.make_automaton()

    def __call__(self, found: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Runs of hit words [first, stop) and the ids of the items found."""
        runs: list[tuple[int, int]] = []
        items: set[str] = set()
        for last, (length, ids) in self.automaton.iter("".join(map(self.symbols.__getitem__, found))):
            items.update(ids)
            runs.append((last - length + 1, last + 1))
        return merged(runs), items


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, stop in sorted(runs):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((first, stop))
    return out


def with_contamination(
    docs: DataFrame, items: DataFrame, into: str = "contamination", *, window: int = 10, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """``docs`` plus a struct: n_words, n_hit, the item ids found and the hit spans in code points."""
    spark = docs.sparkSession
    sent = [spark.sparkContext.broadcast(block) for block in blocks(items, window, block_words)]

    def start():
        scanners: dict[int, Scanner] = {}

        def scan(texts: pa.Array) -> list[dict]:
            rows = [(text, words(text), [], set()) for text in texts.to_pylist()]
            for k, block in enumerate(sent):
                if k not in scanners:
                    scanners.clear()  # one automaton at a time
                    scanners[k] = Scanner(block.value)
                for _, found, runs, ids in rows:
                    more, hit = scanners[k](found)
                    runs += more
                    ids |= hit
            return [mark(text, len(found), merged(runs), ids) for text, found, runs, ids in rows]

        return scan

    return with_text_column(docs, into, MARK, start)


def mark(text: str, n_words: int, runs: list[tuple[int, int]], items: set[str]) -> dict:
    spans = []
    if runs:
        places = [m.span() for m in WORD.finditer(text.translate(LOWER))]
        spans = [{"start": places[first][0], "stop": places[stop - 1][1]} for first, stop in runs]
    return {"n_words": n_words, "n_hit": sum(b - a for a, b in runs), "items": sorted(items), "spans": spans}

