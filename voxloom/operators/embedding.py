"""Vectors for comments: supplied, made by a user's encoder, or hashed TF-IDF."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.feature import IDF, HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.functions import text as T
from voxloom.functions import tokens as K
from voxloom.operators.arrays import unit
from voxloom.session import stored
from voxloom.settings import Settings, uses_query_prefix


def supplied_vectors(comments: DataFrame, vectors: DataFrame) -> DataFrame:
    """comments joined with (row_id, vec), scaled to unit length."""
    return unit(comments.join(vectors.select("row_id", "vec"), "row_id"))


def encoded(
    comments: DataFrame, encode: Callable[[list[str]], np.ndarray], settings: Settings
) -> DataFrame:
    """row_id, vec from ``encode(texts)``, called inside the tasks in batches of embed_batch_size."""
    inputs = comments.select(
        "row_id", T.encoder_input(F.col("cleaned_text"), uses_query_prefix(settings)).alias("text")
    )
    size = settings.embed_batch_size

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), size):
                part = batch.iloc[start : start + size]
                made = np.asarray(encode(part["text"].tolist()), dtype=np.float32)
                yield pd.DataFrame({"row_id": part["row_id"].to_numpy(), "vec": list(made)})

    return _float_vectors(unit(inputs.mapInPandas(run, "row_id long, vec array<float>")))


def hashed_tfidf(comments: DataFrame, settings: Settings, sparse: bool = False) -> DataFrame:
    """row_id, vec: TF-IDF of the tokens over ``hash_dims`` hash buckets, unit length; JVM only.

    The tokens are hashed once and their counts written as sparse vectors. What is left to do is so little that
    nothing wide is kept for those who read the vectors several times. ``sparse``: vec is a sparse ml vector.
    """
    words = comments.select("row_id", K.tokens(F.col("cleaned_text")).alias("words"))
    hashing = HashingTF(inputCol="words", outputCol="tf", numFeatures=settings.hash_dims)
    counted = stored(hashing.transform(words).select("row_id", "tf"), "counts")
    weighted = IDF(inputCol="tf", outputCol="tfidf").fit(counted).transform(counted)
    scaled = Normalizer(inputCol="tfidf", outputCol="unit").transform(weighted)
    if sparse:
        return scaled.select("row_id", F.col("unit").alias("vec"))
    return scaled.select("row_id", vector_to_array("unit", "float32").alias("vec"))


def _float_vectors(df: DataFrame) -> DataFrame:
    return df.select("row_id", F.col("vec").cast("array<float>").alias("vec"))
