"""Saved state: signatures, cached vectors, finished topic results, finished analyses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_TABLES = ("labels", "keywords", "topics", "params", "metrics", "stats")


def signature_row(df: DataFrame, id_col: str, text_col: str, context: str = "") -> DataFrame:
    """One row: signature, 12 characters that change with any text, its id, or ``context``.

    Digests of (id, text) are summed and xored, so the order of rows, which Spark does not keep, does
    not matter, while the order given by the ids does.
    """
    digest = F.md5(F.concat_ws(":", F.col(id_col).cast("string"), text_col))
    number = F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")
    sums = df.agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum(number.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias("total"),
        F.coalesce(F.bit_xor(number), F.lit(0)).alias("mixed"),
    )
    parts: list[Column] = [F.col(c).cast("string") for c in ("n", "total", "mixed")]
    return sums.select(F.substring(F.md5(F.concat_ws("-", *parts, F.lit(context))), 1, 12).alias("signature"))


def signature(df: DataFrame, id_col: str, text_col: str, context: str = "") -> str:
    return signature_row(df, id_col, text_col, context).first()["signature"]


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException:  # missing, or left behind without files
        return None


def kept(rows: DataFrame, path: str) -> DataFrame:
    """The rows as a table at ``path``: read when a finished copy is there, else written first."""
    spark, done = rows.sparkSession, f"{path}/done"
    if _read(spark, done) is None:
        rows.write.mode("overwrite").parquet(f"{path}/rows")
        spark.createDataFrame([(True,)], "done boolean").coalesce(1).write.mode("overwrite").parquet(done)
    return spark.read.parquet(f"{path}/rows")


def cached_vectors(
    comments: DataFrame, make: Callable[[DataFrame], DataFrame], folder: str, model: str, sig: str
) -> DataFrame:
    """row_id, vec: read when a complete copy is there, else made, written and read back."""
    spark, path = comments.sparkSession, f"{folder}/vectors/model={model}/sig={sig}"
    held = _read(spark, path)
    if held is not None and held.count() == comments.count():
        return held
    make(comments).select("row_id", "vec").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def save_result(tables: dict[str, DataFrame], folder: str, sig: str) -> None:
    """Write the tables, then the manifest that makes them count."""
    base = f"{folder}/checkpoint/sig={sig}"
    for name in CHECKPOINT_TABLES:
        tables[name].write.mode("overwrite").parquet(f"{base}/{name}")
    spark = tables["labels"].sparkSession
    manifest = spark.createDataFrame([(sig,)], "signature string")
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{base}/manifest")


def load_result(spark: SparkSession, folder: str, sig: str) -> dict[str, DataFrame] | None:
    """The saved tables; None when there are none, they are incomplete, or belong to other data."""
    base = f"{folder}/checkpoint/sig={sig}"
    manifest = _read(spark, f"{base}/manifest")
    if manifest is None or manifest.filter(F.col("signature") == sig).isEmpty():
        return None
    tables = {name: _read(spark, f"{base}/{name}") for name in CHECKPOINT_TABLES}
    return None if any(t is None for t in tables.values()) else tables


def finished_outputs(spark: SparkSession, folder: str, sig: str) -> DataFrame | None:
    return _read(spark, f"{folder}/analysis/sig={sig}")


def append_outputs(outputs: DataFrame, folder: str, sig: str) -> None:
    outputs.write.mode("append").parquet(f"{folder}/analysis/sig={sig}")
