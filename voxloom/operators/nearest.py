"""Best matches of many rows among a set of reference vectors, exactly, without pairing rows in SQL.

Up to the broadcast limit the references travel to the tasks and every Arrow batch is one matrix
product. Beyond it both sides are cut into blocks; a task gets one block pair and returns only the best
match per row, which a partial aggregation then reduces.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.operators.lookup import settled
from voxloom.settings import Settings

MATCH_SCHEMA = "id long, skip long, squared double, own_score double, match_id long, score double"


def _scores(left: np.ndarray, right: np.ndarray, cosine: bool, eps: float) -> np.ndarray:
    products = left @ right.T
    if cosine:
        lengths = np.outer(np.linalg.norm(left, axis=1), np.linalg.norm(right, axis=1))
        products = products / (lengths + eps)
    return products


def _best(ids, skips, left, ref_ids, refs, cosine, eps) -> tuple[np.ndarray, ...]:
    """The columns of MATCH_SCHEMA; references are sorted by id, so ties go to the lowest id.

    A missing value is NaN in the score columns and -1 as match id.
    """
    scores = _scores(left, refs, cosine, eps)
    rows = np.arange(len(ids))
    place = np.clip(np.searchsorted(ref_ids, skips), 0, len(ref_ids) - 1)
    known = ref_ids[place] == skips
    own = np.where(known, scores[rows, place], np.nan)
    scores[rows[known], place[known]] = -np.inf
    at = scores.argmax(axis=1)
    top = scores[rows, at]
    found = np.isfinite(top)
    squared = np.einsum("ij,ij->i", left, left)
    return ids, skips, squared, own, np.where(found, ref_ids[at], -1), np.where(found, top, np.nan)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def best_match(
    rows: DataFrame, references: DataFrame, settings: Settings, *, cosine: bool = True, eps: float = 1e-9
) -> DataFrame:
    """For every row the best reference other than its own ``skip`` id, and the score of that own one.

    rows: id, skip, vec. references: id, vec. ``match_id``, ``score`` and ``own_score`` are null where
    there is no such reference; ``squared`` is the row's own squared length.
    """
    slim = rows.select(
        F.col("id").cast("long"), F.col("skip").cast("long"), F.col("vec").cast("array<double>").alias("vec")
    )
    references = settled(
        references.select(F.col("id").cast("long"), F.col("vec").cast("array<double>").alias("vec"))
    )
    n_refs, width = references.agg(F.count("*"), F.max(F.size("vec"))).first()
    width = width or 1
    if n_refs * (width + 1) * 8 <= settings.broadcast_bytes:
        matched = _by_broadcast(slim, references, cosine, eps)
    else:
        per_block = max(1, settings.broadcast_bytes // (8 * (width + 1)))
        matched = _by_blocks(slim, references, math.ceil(n_refs / per_block), per_block, cosine, eps)
    return matched.select(
        "id",
        "skip",
        "squared",
        F.nanvl("own_score", F.lit(None)).alias("own_score"),
        F.when(F.col("match_id") >= 0, F.col("match_id")).alias("match_id"),
        F.nanvl("score", F.lit(None)).alias("score"),
    )


def _by_broadcast(rows: DataFrame, references: DataFrame, cosine: bool, eps: float) -> DataFrame:
    held = references.orderBy("id").toArrow()  # size checked by the caller
    ref_ids = held.column("id").to_numpy()
    refs = np.array(held.column("vec").to_pylist(), dtype=np.float64)
    shared = rows.sparkSession.sparkContext.broadcast((ref_ids, refs))
    names = rows.sparkSession.createDataFrame([], MATCH_SCHEMA).columns

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known_ids, known = shared.value
        for batch in batches:
            if batch.num_rows == 0 or len(known_ids) == 0:
                continue
            found = _best(
                batch.column("id").to_numpy(),
                batch.column("skip").to_numpy(),
                _matrix(batch.column("vec")),
                known_ids,
                known,
                cosine,
                eps,
            )
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names)

    return rows.mapInArrow(match, MATCH_SCHEMA)


def _by_blocks(
    rows: DataFrame, references: DataFrame, blocks: int, per_chunk: int, cosine: bool, eps: float
) -> DataFrame:
    chunks = max(1, math.ceil(rows.count() / per_chunk))
    names = rows.sparkSession.createDataFrame([], MATCH_SCHEMA).columns

    def match(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({name: [] for name in names})
        right = right.sort_values("id")
        found = _best(
            left["id"].to_numpy(),
            left["skip"].to_numpy(),
            np.stack(left["vec"].to_numpy()),
            right["id"].to_numpy(),
            np.stack(right["vec"].to_numpy()),
            cosine,
            eps,
        )
        return pd.DataFrame(dict(zip(names, found)))

    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    every_chunk = F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))
    left = rows.withColumn("chunk", F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int")).withColumn(
        "block", every_block
    )
    right = references.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).withColumn(
        "chunk", every_chunk
    )
    pairs = left.groupBy("chunk", "block").cogroup(right.groupBy("chunk", "block"))
    real = F.when(F.col("match_id") >= 0, F.struct("score", (-F.col("match_id")).alias("minus_id")))
    return (
        pairs.applyInPandas(match, MATCH_SCHEMA)
        .groupBy("id")
        .agg(
            F.first("skip").alias("skip"),
            F.first("squared").alias("squared"),
            F.max(F.nanvl("own_score", F.lit(None))).alias("own_score"),
            F.max(real).alias("b"),
        )
        .select(
            "id",
            "skip",
            "squared",
            "own_score",
            F.coalesce(-F.col("b.minus_id"), F.lit(-1)).alias("match_id"),
            F.col("b.score").alias("score"),
        )
    )
