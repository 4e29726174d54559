"""Reading and checking the JSON a model returned for a topic, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxloom.functions import analysis_texts as X
from voxloom.functions.text import SPACE_CLASS

ANSWER_FIELDS = ("business_name", "description", "root_cause", "severity", "sentiment")


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"^[{SPACE_CLASS}]+|[{SPACE_CLASS}]+$", "")


def words(c: Column) -> Column:
    """Words separated by white space; an empty array for a blank text."""
    return F.filter(F.split(c, f"[{SPACE_CLASS}]+"), lambda w: w != "")


def json_text(answer: Column) -> Column:
    """From the first { to the last }, reasoning blocks removed; '' when there is none."""
    spoken = F.regexp_replace(answer, r"(?s)<think>.*?</think>", "")
    return F.regexp_extract(spoken, r"(?s)\{.*\}", 0)


def parse_fields(answer: Column) -> Column:
    """MAP of key to value text; null when the answer holds no JSON object."""
    return F.from_json(F.nullif(json_text(answer), F.lit("")), "map<string,string>")


def parse_actions(answer: Column, fields: Column) -> Column:
    """recommended_actions as trimmed, non-blank texts; a single value counts as a list of one."""
    listed = F.from_json(json_text(answer), "recommended_actions array<string>")["recommended_actions"]
    single = F.array(F.coalesce(fields["recommended_actions"], F.lit("None")))
    missing = F.array().cast("array<string>")
    held = F.coalesce(F.map_contains_key(fields, F.lit("recommended_actions")), F.lit(False))
    items = F.when(~held, missing).otherwise(F.coalesce(listed, single))
    return F.filter(F.transform(items, lambda a: strip(F.coalesce(a, F.lit("None")))), lambda a: a != "")


def field(fields: Column, key: str) -> Column:
    """A value as trimmed text: '' for a missing key, the word None for JSON null."""
    held = F.coalesce(F.map_contains_key(fields, F.lit(key)), F.lit(False))
    return F.when(held, strip(F.coalesce(fields[key], F.lit("None")))).otherwise("")


def contract_errors(fields: Column, actions: Column) -> Column:
    """ARRAY of messages, empty when the answer keeps the contract."""
    missing = [
        F.when(
            ~F.coalesce(F.map_contains_key(fields, F.lit(key)), F.lit(False)), F.lit(X.MISSING_KEY + key)
        )
        for key in X.REQUIRED_KEYS
    ]
    name = field(fields, "business_name")
    n_words = F.size(words(name))
    checks = [
        F.when(~field(fields, "severity").isin(*X.SEVERITIES), F.lit(X.BAD_SEVERITY)),
        F.when(~field(fields, "sentiment").isin(*X.SENTIMENTS), F.lit(X.BAD_SENTIMENT)),
        F.when(F.size(actions) != 3, F.lit(X.BAD_ACTIONS)),
        F.when(name.isin(*X.GENERIC_NAMES) | (n_words < 2) | (n_words > 4), F.lit(X.BAD_NAME)),
    ]
    return F.filter(F.array(*missing, *checks), lambda e: e.isNotNull())


def fallback_name(keywords: Column) -> Column:
    spoken = F.array_distinct(F.flatten(F.transform(F.slice(keywords, 1, 4), words)))
    name = F.when(F.size(spoken) > 0, F.array_join(F.slice(spoken, 1, 3), " ")).otherwise(X.FALLBACK_NAME)
    return F.when(F.size(words(name)) < 2, F.concat(name, F.lit(X.FALLBACK_NAME_PAD))).otherwise(name)
