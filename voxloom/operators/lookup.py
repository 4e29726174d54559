"""Attach small tables to large ones: broadcast behind a size check, salted beyond it."""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.settings import Settings

TEXT_BYTES = 16 * 1024 * 1024  # text meant for one partition where words are counted
DEAL = "_deal"  # the partition that a row was dealt to


def settled(df: DataFrame) -> DataFrame:
    """Keep a topic-level table once computed; lost parts are computed again from their lineage."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def measured_bytes(df: DataFrame) -> int:
    """Bytes of a table as text, by one aggregate; an upper estimate of its broadcast size."""
    row = df.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))) + 16).alias("bytes")).first()
    return row["bytes"] or 0


def attach(
    big: DataFrame,
    small: DataFrame,
    keys: list[str] | str,
    *,
    spread_by: str,
    settings: Settings,
    how: str = "left",
) -> DataFrame:
    """``big`` left or inner join ``small`` (unique on ``keys``), whatever the skew of the keys.

    Up to ``settings.broadcast_bytes`` the small side is broadcast and ``big`` does not move. A larger
    one is repeated over salts, so that even one key with most of the rows is spread over many tasks.
    """
    keys = [keys] if isinstance(keys, str) else keys
    small = settled(small)
    if measured_bytes(small) <= settings.broadcast_bytes:
        return big.join(F.broadcast(small), keys, how)
    salts = settings.lookup_salts
    salted = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return (
        big.withColumn("_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int"))
        .join(salted, [*keys, "_salt"], how)
        .drop("_salt")
    )


def labelled_texts(texts: DataFrame, labels: DataFrame, key: str = "row_id", text: str = "cleaned_text") -> DataFrame:
    """``texts`` inner join ``labels`` by ``key``, in partitions of about TEXT_BYTES of text, plus DEAL, their number.

    There are more of them for a larger table, measured by one aggregate, so what a task holds to count the
    words behind the join does not grow. Both sides are dealt alike, and the texts move once. As DEAL names the
    partition, rows grouped by it and other columns are combined where they are; its metadata has their number.
    """
    size = texts.agg(F.sum(F.octet_length(text)).alias("bytes")).first()["bytes"] or 0
    parts = max(texts.sparkSession.sparkContext.defaultParallelism, math.ceil(size / TEXT_BYTES))
    deal = F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")
    put = lambda rows: rows.withColumn(DEAL, deal.alias(DEAL, metadata={"parts": parts})).repartitionById(parts, DEAL)
    return put(texts).join(put(labels), [DEAL, key])
