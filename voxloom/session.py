"""Session helpers. On a cluster the session is given; local runs build one here."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("voxloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, named by ``spark.checkpoint.dir``.

    Only a local session that names none gets a temporary folder; on a cluster executors could not see it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rsplit("/", 1)[0]
    if not context.master.startswith("local"):
        raise ValueError("Set spark.checkpoint.dir to a folder that driver and executors share.")
    folder = tempfile.mkdtemp(prefix="voxloom-")
    context.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of executors, ends the plan here."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, read in splits and column by column."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_round(df: DataFrame) -> DataFrame:
    """``cut_lineage`` for a table that the next round of a loop joins with itself.

    A checkpoint keeps the optimizer's guess of its bytes, and that of a join is the product of both sides. So
    the guess would square from round to round, until it has millions of digits and planning takes longer than the
    rows. A written table has the size it has.
    """
    return stored(df, "round")
