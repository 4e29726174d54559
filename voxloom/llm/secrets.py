"""Secret scan: fixed patterns, and zstandard novelty of strings in a sensitive context.

Patterns (kinds ``assign``, ``access``, ``hex``) are matched as they are. Beyond them, every long run of
key characters that holds letters and digits and has a sensitive word shortly before it is a candidate.
Its novelty is the number of bytes by which it makes its surroundings longer, compressed by zstandard
with a dictionary of identifiers primed: identifiers, words and repetitions cost little, random strings
cost nearly what they hold. Other copies of a candidate, or of a part of it that looks like a key itself,
are first taken out of its surroundings. Candidates of at least ``novelty`` bytes a character are reported
(``novel``), and with one of them every equal string of key characters in the text.

The identifier dictionary is made of the identifiers in most documents of the whole corpus, counted by
Spark; its size is bounded by ``dictionary_bytes``, as a compressor looks back only so far.

Cases: null and empty texts hold nothing; every row is judged alone, so repeated rows have equal spans;
without identifiers the dictionary is empty; other columns are kept as they are. Offsets are code points.
"""

from __future__ import annotations

import re
from collections import defaultdict

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm.common import with_text_column

SPAN = "struct<kind string, start long, stop long>"
FOUND = f"struct<base array<{SPAN}>, novel array<{SPAN}>>"
KINDS = ("assign", "access", "hex", "novel")

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # the runs of [0-9a-f]+ that are long enough
RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
SENSITIVE = re.compile(r"key|secret|token|auth|bearer|credential|passw|pwd|private|signature|cookie|session", re.I | re.A)
COPY = 16  # characters with letters and digits that surroundings and candidate share are a copy of a key
# Names in code, made of words: a random string hardly ever looks like that, even if it is repeated.
IDENTIFIER = r"\b([A-Za-z]{2,}(?:_(?:[A-Za-z]+|[0-9]{1,3}))+|[a-z]{2,}(?:[A-Z][a-z]{2,})+)\b"


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Leftmost matches of each kind that do not overlap, without those that are too short."""
    spans = []
    lowered = text.lower()
    if any(hint in lowered for hint in ASSIGN_HINTS):
        spans += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        spans += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    spans += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return in_order(spans)


def in_order(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


class Novelty:
    """Bytes that a candidate adds to its compressed surroundings, for each of its characters."""

    def __init__(self, dictionary: bytes, level: int = 3):
        options = {"level": level, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
        if len(dictionary) >= 8:
            primed = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            primed.precompute_compress(level=level)
            options |= {"dict_data": primed}
        self.compressor = zstandard.ZstdCompressor(**options)

    def __call__(self, surroundings: str, candidate: str) -> float:
        before = surroundings.encode()
        marginal = len(self.compressor.compress(before + candidate.encode())) - len(self.compressor.compress(before))
        return marginal / len(candidate)


def novel_spans(
    text: str, base: list[tuple[str, int, int]], measure: Novelty, novelty: float, near: int, around: int
) -> list[tuple[str, int, int]]:
    places = defaultdict(list)
    for m in RUN.finditer(text):
        start, stop = m.span()
        run = m[0]
        if run.isalpha() or not any(c.isdigit() for c in run) or any(a < stop and start < b for _, a, b in base):
            continue
        places[run].append((start, stop))
    spans = []
    for run, found in places.items():
        if any(
            SENSITIVE.search(text, max(0, start - near), start)
            and measure(surroundings(text, start, stop, around), run) >= novelty
            for start, stop in found
        ):
            spans += [("novel", start, stop) for start, stop in found]
    return in_order(spans)


def surroundings(text: str, start: int, stop: int, around: int) -> str:
    """What lies around a candidate, without copies of it: they would make it cost nothing."""
    sides = text[max(0, start - around) : start], text[stop : stop + around]
    run = text[start:stop]
    parts = {run[k : k + COPY] for k in range(len(run) - COPY + 1)}
    return "".join(without_copies(side, parts) + " " for side in sides)


def without_copies(side: str, parts: set[str]) -> str:
    kept, done, k = [], 0, 0
    while k <= len(side) - COPY:
        stop = k
        while side[stop : stop + COPY] in parts:
            stop += 1
        if stop > k:
            copy = side[k : stop + COPY - 1]
            if any(c.isdigit() for c in copy) and any(c.isalpha() for c in copy):
                kept.append(side[done:k])
                done = stop + COPY - 1
            k = stop + COPY - 1
        else:
            k += 1
    return " ".join([*kept, side[done:]])


def identifier_dictionary(docs: DataFrame, dictionary_bytes: int = 1 << 16, least_docs: int = 2) -> bytes:
    """The identifiers found in most documents, the most frequent last, where the compressor finds them first."""
    names = F.array_distinct(F.regexp_extract_all(F.col("text").cast("string"), F.lit(IDENTIFIER), 1))
    counts = docs.select(F.explode(names).alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    most = dictionary_bytes // 4  # an identifier and the line end have four bytes at least
    top = counts.where((F.col("n") >= least_docs) & (F.length("name") <= 64)).orderBy(F.desc("n"), "name").limit(most)
    kept, size = [], 0
    for row in top.collect():
        size += len(row.name.encode()) + 1
        if size > dictionary_bytes:
            break
        kept.append(row.name)
    return "\n".join(reversed(kept)).encode()


def with_secrets(
    docs: DataFrame, into: str = "secrets", *, novelty: float = 0.62, near: int = 48, around: int = 400,
    dictionary: bytes | None = None,
) -> DataFrame:
    """``docs`` plus a struct of the pattern spans and the novel spans of each whole text."""
    primed = identifier_dictionary(docs) if dictionary is None else dictionary
    sent = docs.sparkSession.sparkContext.broadcast(primed)  # bounded by dictionary_bytes

    def start():
        measure = Novelty(sent.value)

        def scan(texts: pa.Array) -> list[dict]:
            out = []
            for text in texts.to_pylist():
                base = base_spans(text)
                novel = novel_spans(text, base, measure, novelty, near, around)
                out.append({"base": as_rows(base), "novel": as_rows(novel)})
            return out

        return scan

    return with_text_column(docs, into, FOUND, start)


def as_rows(spans: list[tuple[str, int, int]]) -> list[dict]:
    return [{"kind": kind, "start": a, "stop": b} for kind, a, b in spans]


def redacted(docs: DataFrame, found: str = "secrets", mark: str = "[REDACTED]") -> DataFrame:
    """``docs`` with every span replaced by ``mark`` in its text; the column ``found`` is dropped."""
    spans = F.concat(f"{found}.base", f"{found}.novel")
    return docs.withColumn("text", F.when(F.size(spans) > 0, _cut(F.col("text"), spans, mark)).otherwise(F.col("text"))).drop(found)


def _cut(text: F.Column, spans: F.Column, mark: str) -> F.Column:
    """Spans may overlap: what lies before each start, after the furthest stop so far, is kept."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"))))
    begun = F.struct(F.lit("").alias("kept"), F.lit(0).cast("long").alias("at"))

    def step(done: F.Column, span: F.Column) -> F.Column:
        between = F.substr(text, done["at"] + 1, F.greatest(span["start"] - done["at"], F.lit(0)))
        fresh = (span["start"] >= done["at"]) & ((span["start"] > done["at"]) | (done["at"] == 0))
        kept = F.concat(done["kept"], F.when(fresh, F.concat(between, F.lit(mark))).otherwise(F.lit("")))
        return F.struct(kept.alias("kept"), F.greatest(done["at"], span["stop"]).alias("at"))

    return F.aggregate(ordered, begun, step, lambda done: F.concat(done["kept"], F.substr(text, done["at"] + 1)))
