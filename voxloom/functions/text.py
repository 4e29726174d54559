"""Comment cleaning as column expressions; nothing here leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points counted as white space, as members of a regex class.
SPACE_CLASS = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
# The same characters one by one, without the plain space.
OTHER_SPACES = "".join(
    chr(c)
    for first, last in (
        (0x09, 0x0D), (0x1C, 0x1F), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
        (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
    )
    for c in range(first, last + 1)
)
# Pictographs, dingbats, flags, variation selectors, arrows.
EMOJI_CLASS = (
    r"\x{1F300}-\x{1FAFF}\x{2600}-\x{27BF}\x{1F1E6}-\x{1F1FF}\x{FE00}-\x{FE0F}\x{2190}-\x{21FF}"
)
# Punctuation whose runs collapse to their last character.
RUN_PUNCTUATION = r"!?.,:\-_،؛"
# First and last code points of the Arabic marks to strip; letters (U+0621-064A) are not
# among them.
DIACRITIC_RANGES = (
    (0x0610, 0x061A),
    (0x064B, 0x065F),
    (0x0670, 0x0670),
    (0x06D6, 0x06DC),
    (0x06DF, 0x06E8),
    (0x06EA, 0x06ED),
)
# Letter variants and their unified form; tatweel has none and is dropped.
ARABIC_VARIANTS = "أإآىة"
ARABIC_UNIFIED = "ااايه"
TATWEEL = "ـ"
ARABIC_BLOCK = r"[\x{0600}-\x{06FF}]"


def drop_urls(c: Column) -> Column:
    rest = f"[^{SPACE_CLASS}]+"
    return F.regexp_replace(c, rf"https?://{rest}|www\.{rest}", " ")


def drop_emoji(c: Column) -> Column:
    return F.regexp_replace(c, f"[{EMOJI_CLASS}]+", " ")


def collapse_punctuation(c: Column) -> Column:
    return F.regexp_replace(c, f"([{RUN_PUNCTUATION}]){{2,}}", "$1")


def shorten_elongation(c: Column, letters_only: bool = False) -> Column:
    repeated = r"\p{L}" if letters_only else r"[^\n]"
    return F.regexp_replace(c, rf"({repeated})\1{{2,}}", "$1$1")


def unify_arabic(c: Column) -> Column:
    """One pass over the characters: variants are replaced, marks and tatweel have no replacement."""
    marks = "".join(chr(m) for first, last in DIACRITIC_RANGES for m in range(first, last + 1))
    return F.translate(c, ARABIC_VARIANTS + TATWEEL + marks, ARABIC_UNIFIED)


def normalize_arabic(c: Column, letters_only: bool = False) -> Column:
    return shorten_elongation(unify_arabic(c), letters_only)


def normalize_spaces(c: Column) -> Column:
    """Any white space becomes a plain space first; the regex then only meets real runs."""
    plain = F.translate(c, OTHER_SPACES, " " * len(OTHER_SPACES))
    return F.trim(F.regexp_replace(plain, " {2,}", " "))


def clean_text(c: Column, letters_only: bool = False) -> Column:
    return normalize_spaces(
        normalize_arabic(collapse_punctuation(drop_emoji(drop_urls(c))), letters_only)
    )


def is_blank(c: Column) -> Column:
    return ~c.rlike(f"[^{SPACE_CLASS}]")


def word_count(cleaned: Column) -> Column:
    """Words of an already cleaned text: single spaces separate them."""
    spaces = F.length(cleaned) - F.length(F.replace(cleaned, F.lit(" "), F.lit("")))
    return F.when(cleaned == "", F.lit(0)).otherwise(spaces + 1)


def has_arabic(c: Column) -> Column:
    return c.rlike(ARABIC_BLOCK)


def dedup_key(cleaned: Column) -> Column:
    return F.lower(F.trim(cleaned))


def encoder_input(cleaned: Column, prefix: bool) -> Column:
    return F.concat(F.lit("query: "), cleaned) if prefix else cleaned


def preview(c: Column, width: int = 120) -> Column:
    return F.when(F.length(c) > width, F.concat(F.substring(c, 1, width), F.lit("…"))).otherwise(c)
