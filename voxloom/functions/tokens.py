"""Tokens and n-grams of cleaned text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word characters are letters, numbers and the underscore; a token may also hold any character of the
# Arabic block, but has to start and end on a word boundary. Java's own \b knows other classes.
_WORD = r"[\p{L}\p{N}_]"
_BOUNDARY = rf"(?:(?<!{_WORD})(?={_WORD})|(?<={_WORD})(?!{_WORD}))"
TOKEN_PATTERN = rf"{_BOUNDARY}[\p{{L}}\p{{N}}_\x{{0600}}-\x{{06FF}}]{{2,}}{_BOUNDARY}"
# The same tokens in lower-case text of one byte per character, where boundaries need no looking around.
ASCII_TOKEN_PATTERN = "[a-z0-9_]{2,}"
# The same tokens in text without the Arabic block, where every run of word characters ends on boundaries.
PLAIN_TOKEN_PATTERN = rf"{_WORD}{{2,}}"
_LOOKS_AROUND = r"[\x{0600}-\x{06FF}\x{10000}-\x{10FFFF}]"  # looking around cuts letters above U+FFFF at an edge


def tokens(cleaned: Column) -> Column:
    low = F.lower(cleaned)
    found = lambda pattern: F.regexp_extract_all(low, F.lit(pattern), F.lit(0))
    return (
        F.when(F.octet_length(cleaned) == F.length(cleaned), found(ASCII_TOKEN_PATTERN))
        .when(~cleaned.rlike(_LOOKS_AROUND), found(PLAIN_TOKEN_PATTERN))
        .otherwise(found(TOKEN_PATTERN))
    )


def without(token_array: Column, words: list[str]) -> Column:
    """Drop stop words but keep repeated tokens (array_except would not)."""
    return F.filter(token_array, lambda t: ~t.isin(words))


def with_ngrams(token_array: Column, n_max: int) -> Column:
    """The tokens followed by their n-grams; needs a materialised array column."""
    grams = token_array
    for n in range(2, n_max + 1):
        shifted = [F.slice(token_array, F.lit(i + 1), F.size(token_array)) for i in range(n)]
        joined = shifted[0]
        for nxt in shifted[1:]:
            joined = F.zip_with(joined, nxt, lambda a, b: F.concat(a, F.lit(" "), b))
        grams = F.concat(grams, F.filter(joined, lambda g: g.isNotNull()))
    return grams
