"""Result tables to files: one directory per table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# quotes are doubled, and blanks at the ends of a text stay
CSV_OPTIONS = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_tables(tables: dict[str, DataFrame], folder: str, file_format: str = "parquet") -> None:
    """Write each table to ``folder/name``; CSV gets a header."""
    for name, df in tables.items():
        writer = df.write.mode("overwrite")
        if file_format == "csv":
            writer.options(**CSV_OPTIONS).csv(f"{folder}/{name}")
        else:
            writer.format(file_format).save(f"{folder}/{name}")


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object per line."""
    df.write.mode("overwrite").json(path)


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """A single text, such as the executive summary, as one file."""
    one = spark.createDataFrame([(text,)], "value string")
    one.coalesce(1).write.mode("overwrite").text(path)
