"""URL filter: rules first, then a naive Bayes over segmented host and path words.

Host names write words together. Their labels are split with a unigram model (the most likely sequence
of words, found by the Viterbi algorithm); the words are counted over the whole table's page texts. For
every distinct label all substrings are looked up in the counts by a join, so no dictionary is sent
anywhere and none is cut off. A multinomial naive Bayes, trained on labelled URLs (a parameter; the list
here is an example), then scores the words of host and path; a word it has never seen is neutral.

Rules name a host and the beginning of a path and fit the host and all its subdomains; the longest rule
that fits decides.

Cases: a null url or one without ``://`` has empty host and path, which no rule fits and the classifier
allows; a label above 63 characters is no DNS name and stays one word; repeated rows are judged alike;
without page texts labels stay whole; other columns are not looked at.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm.common import batches

LONGEST_LABEL = 63
LONGEST_WORD = 24
# Examples to learn from: word lists of hosts and paths that are wanted or not.
LABELLED = (
    ("block", "casino win bets poker jackpot slots spin gambling roulette lottery bonus bet"),
    ("block", "adult xxx porn sex nude cams escort dating hot x"),
    ("block", "spam farm free cheap pills viagra pharmacy loan credit money prize winner click offer"),
    ("block", "warez crack keygen torrent hack malware phishing"),
    ("allow", "news blog journal magazine press weather sports daily times post"),
    ("allow", "university school library science research museum history archive docs wiki"),
    ("allow", "shop store books music travel recipes garden health family home about contact"),
    ("allow", "forum help support developer code software open source project data www mobile page en de fr es"),
)


def parsed(url: F.Column) -> tuple[F.Column, F.Column]:
    """Host (A-Z lower-cased) and path of a URL as written; both empty without ``://``."""
    url = F.coalesce(url, F.lit(""))
    rest = F.when(F.locate("://", url) > 0, F.substr(url, F.locate("://", url) + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, upper, upper.lower()), path


def ruled(host: F.Column, path: F.Column, rules: Sequence[tuple[str, str]]) -> tuple[F.Column, F.Column]:
    """The longest rule that fits, and what it says; ties go to the smaller rule."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: (len(r[0]), [-ord(c) for c in r[0]])):
        name, slash, start = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + start)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def word_counts(texts: F.Column, rows: DataFrame) -> DataFrame:
    """word, n over all texts: runs of ASCII letters outside tags, in lower case."""
    visible = F.lower(F.regexp_replace(texts, r"<[^>]*>", " "))
    words = rows.select(F.explode(F.split(visible, r"[^a-z]+")).alias("word"))
    return words.where(F.length("word").between(1, LONGEST_WORD)).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def viterbi(label: str, counts: dict[str, int], total: int) -> list[str]:
    """The most likely words; a word without count costs the more the longer it is."""
    best: list[tuple[float, int]] = [(0.0, 0)]
    for stop in range(1, len(label) + 1):
        options = []
        for start in range(max(0, stop - LONGEST_WORD), stop):
            word = label[start:stop]
            n = counts.get(word, 0)
            chance = math.log(n / total) if n else -math.log(total) - 2.3 * len(word)
            options.append((best[start][0] + chance, -(stop - start)))
        best.append(max(options))
    words, stop = [], len(label)
    while stop:
        size = -best[stop][1]
        words.append(label[stop - size : stop])
        stop -= size
    return words[::-1]


def segmented(labels: DataFrame, counts: DataFrame) -> DataFrame:
    """label, words for the distinct labels of a table."""
    labels = labels.select("label").distinct()
    starts = F.explode(F.sequence(F.lit(1), F.length("label")))
    parts = labels.where(F.length("label").between(1, LONGEST_LABEL)).select("label", starts.alias("start"))
    ends = F.least(F.lit(LONGEST_WORD), F.length("label") - F.col("start") + 1)
    parts = parts.select("label", "start", F.explode(F.sequence(F.lit(1), ends)).alias("size"))
    parts = parts.select("label", F.substr("label", F.col("start"), F.col("size")).alias("word")).distinct()
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] + 1
    known = parts.join(counts, "word").groupBy("label")  # at most 63 * 24 parts of one label
    known = known.agg(F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("counts"))

    def split(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(rows):
            made = []
            for label, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                short = 0 < len(label) <= LONGEST_LABEL
                made.append(viterbi(label, dict(found or ()), total) if short and found else [label])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.list_(pa.string()))], ["label", "words"])

    return labels.join(known, "label", "left").select("label", "counts").mapInArrow(split, "label string, words array<string>")


def naive_bayes(labelled: Sequence[tuple[str, str]]) -> dict[str, float]:
    """For each word of the labelled texts the log odds of ``block``, with one pseudo count."""
    counts = {"block": Counter(), "allow": Counter()}
    for verdict, text in labelled:
        counts[verdict].update(re.findall(r"[a-z]+", text.lower()))
    words = counts["block"].keys() | counts["allow"].keys()
    sizes = {v: sum(c.values()) + len(words) for v, c in counts.items()}
    return {
        w: math.log((counts["block"][w] + 1) / sizes["block"]) - math.log((counts["allow"][w] + 1) / sizes["allow"])
        for w in sorted(words)
    }


def judged(
    pages: DataFrame, rules: Sequence[tuple[str, str]], labelled: Sequence[tuple[str, str]] = LABELLED, *,
    url: str = "url", text: str = "html", key: str = "page_id", threshold: float = 0.0,
) -> DataFrame:
    """key, host, path, rule, verdict, host_words and score (log odds of block) of every page."""
    host, path = parsed(F.col(url).cast("string"))
    rows = pages.select(F.col(key).alias("page_id"), host.alias("host"), path.alias("path"))
    hosts = rows.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    labels = F.split("host", r"[^a-z]+")
    places = hosts.select("host", F.posexplode(labels).alias("at", "label")).where(F.col("label") != "")
    counts = word_counts(F.coalesce(F.col(text).cast("string"), F.lit("")), pages)
    words = places.join(segmented(places, counts), "label")
    words = words.groupBy("host").agg(F.array_sort(F.collect_list(F.struct("at", "words"))).alias("parts"))
    words = words.select("host", F.flatten(F.transform("parts", lambda p: p["words"])).alias("host_words"))
    odds = naive_bayes(labelled)
    model = F.create_map(*[F.lit(x) for w in odds for x in (w, odds[w])])
    add = lambda words: F.aggregate(words, F.lit(0.0), lambda s, w: s + F.coalesce(F.element_at(model, w), F.lit(0.0)))
    # A host may hold a third of all pages; its words are one row, and a skewed join is split by Spark.
    rows = rows.join(words.withColumn("host_score", add(F.col("host_words"))), "host", "left")
    score = F.coalesce(F.col("host_score"), F.lit(0.0)) + add(F.split(F.lower("path"), r"[^a-z]+"))
    rule, says = ruled(F.col("host"), F.col("path"), rules)
    rows = rows.select("page_id", "host", "path", rule.alias("rule"), says.alias("says"), "host_words", score.alias("score"))
    verdict = F.coalesce("says", F.when(F.col("score") > threshold, "block").otherwise("allow"))
    return rows.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "host_words", "score")
