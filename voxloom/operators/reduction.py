"""Principal components of the vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from voxloom.settings import Settings

BLOCK = 1024  # rows that are multiplied at once


def blocks(batch: pa.RecordBatch, width: int):
    """Matrices of the rows' ml vectors, BLOCK rows each."""
    for start in range(0, batch.num_rows, BLOCK):
        vec = batch.column(batch.schema.get_field_index("vec")).slice(start, BLOCK)
        if vec.null_count:
            raise ValueError("a vector is null")
        at, values, out = pc.struct_field(vec, "indices"), pc.struct_field(vec, "values"), np.zeros((len(vec), width))
        sparse = at.is_valid().to_numpy(zero_copy_only=False)
        of = np.repeat(np.arange(len(vec)), pc.list_value_length(at).fill_null(0).to_numpy())
        out[of, at.flatten().to_numpy()] = values.filter(pa.array(sparse)).flatten().to_numpy()
        out[~sparse] = values.filter(pa.array(~sparse)).flatten().to_numpy().reshape(-1, width)
        yield out


def covariance(vectors: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance of vec in one pass: each task sends the lower half of one width x width matrix."""

    def add(batches):
        n, total, products = 0, np.zeros(width), np.zeros((width, width))
        for batch in batches:
            for rows in blocks(batch, width):
                n += len(rows)
                total += rows.sum(0)
                products += rows.T @ rows
        if n:
            parts = [np.array([n], np.float64), total, *(products[k, : k + 1] for k in range(width))]
            yield pa.RecordBatch.from_pydict({"part": pa.array(range(-2, width), pa.int32()), "vec": pa.array(parts, pa.list_(pa.float64()))})

    sums = vectors.select("vec").mapInArrow(add, "part int, vec array<double>")
    sums = sums.groupBy("part").agg(vector_to_array(Summarizer.sum(array_to_vector("vec"))).alias("vec")).toPandas()
    held = dict(zip(sums["part"], sums["vec"]))
    n = held[-2][0] if held else 0
    if n < 2:
        raise ValueError("principal components need at least two vectors")
    mean, products = np.array(held[-1]) / n, np.zeros((width, width))
    for k in range(width):
        products[k, : k + 1] = products[: k + 1, k] = held[k]
    return mean, (products - n * np.outer(mean, mean)) / (n - 1)


def reduced(vectors: DataFrame, n: int, settings: Settings) -> DataFrame:
    """row_id, vec ARRAY<DOUBLE>: centred projections on the leading components.

    The number of components is limited by the width and by n - 1. A component's sign is free; it is
    set so that its largest loading is positive. The driver holds one width x width matrix, no rows.
    vec: an array, or an ml vector, which stays sparse.
    """
    if isinstance(vectors.schema["vec"].dataType, VectorUDT):
        return reduced_sparse(vectors, n, settings)
    rows = vectors.select("row_id", array_to_vector(F.col("vec").cast("array<double>")).alias("v"))
    width = vectors.select(F.size("vec")).first()[0]
    k = min(settings.pca_components, width, max(2, n - 1))
    model = PCA(k=k, inputCol="v", outputCol="p").fit(rows)
    loadings = model.pc.toArray()
    signs = np.sign(loadings[np.abs(loadings).argmax(axis=0), np.arange(k)])
    projected = model.transform(rows).select("row_id", "p")
    # the model's own covariance is centred, its projection is not: take the mean off afterwards
    center = projected.agg(Summarizer.mean(F.col("p")).alias("m")).first()["m"].toArray()
    fixed = F.array(*[F.struct(F.lit(float(m)).alias("m"), F.lit(float(s)).alias("s")) for m, s in zip(center, signs)])
    return projected.select(
        "row_id", F.zip_with(vector_to_array("p"), fixed, lambda x, f: (x - f["m"]) * f["s"]).alias("vec")
    )


def reduced_sparse(vectors: DataFrame, n: int, settings: Settings) -> DataFrame:
    """``reduced`` for ml vectors: each is spread out only while it is multiplied.

    Equal vectors get equal projections, as each is summed up by itself.
    """
    width = vectors.first()["vec"].size
    k = min(settings.pca_components, width, max(2, n - 1))
    mean, spread = covariance(vectors, width)
    loadings = np.linalg.eigh(spread)[1][:, ::-1][:, :k]
    loadings = loadings * np.sign(loadings[np.abs(loadings).argmax(axis=0), np.arange(k)])
    center = mean @ loadings

    def project(batches):
        for batch in batches:
            made = [np.stack([(rows * loadings[:, j]).sum(1) for j in range(k)], 1) - center for rows in blocks(batch, width)]
            vec = pa.array(list(np.concatenate(made)) if made else [], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("row_id")), vec], names=["row_id", "vec"])

    return vectors.select("row_id", "vec").mapInArrow(project, vectors.select("row_id").schema.add("vec", ArrayType(DoubleType())))
