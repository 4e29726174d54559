"""The corpus pipeline: documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as Parquet in the shared
folder and reads it again as the next stage's docs. All stages but the last return the columns of
documents, extra ones included. Rows of any kind pass: null and empty texts are clean and are kept.

1. toxicity: documents that the counterfactual classifier scores 0.7 or more are dropped.
2. near_duplicates: of each component of documents linked by a Jaccard similarity of 0.8 over five-word
   shingles, the one with the smallest doc_id stays. Rows that share an id but not the text are different
   documents. Documents without words stay, as do rows without id.
3. decontamination: documents that hold a window of ten words of a benchmark item are dropped.
4. secrets: spans that hold secrets are replaced by a mark in the text; n_chars follows the new text.
5. packing: all ids of all texts that are left, in sequences of 4,096.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.llm.common import held_out, table, written
from voxloom.llm.decontamination import with_contamination
from voxloom.llm.jaccard_join import jaccard_components
from voxloom.llm.packing import packed
from voxloom.llm.secrets import redacted, with_secrets
from voxloom.llm.toxicity import with_toxicity
from voxloom.session import cut_lineage

MADE = "_pipeline_made"  # no table has a column of this name


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where(~held_out())
    return with_toxicity(docs, labels, MADE).where(F.col(MADE) < 0.7).drop(MADE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Ids may repeat with other texts, so that an id and its text make a document here; none without id.
    own = F.xxhash64(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")))
    keyed = docs.withColumn(MADE, F.when(F.col("doc_id").isNotNull(), own))
    found = jaccard_components(keyed.select(F.col(MADE).alias("doc_id"), "text"), size=5, share=(80, 100))
    found = cut_lineage(found.where("doc_id is not null and n_shingles > 0").select(F.col("doc_id").alias(MADE), F.col("component_id").alias("of")))
    others = found.where(F.col("of") != F.col(MADE))  # the first key of each component names it
    members = others.unionByName(others.select(F.col("of").alias(MADE), "of")).distinct()
    ids = keyed.where(F.col(MADE).isNotNull()).select(MADE, F.col("doc_id").cast("long").alias("id")).distinct()
    placed = cut_lineage(members.join(ids, MADE))
    stays = placed.groupBy("of").agg(F.min(F.struct("id", MADE)).alias("first")).select(f"first.{MADE}")
    # Only keys of documents that go are joined; a row that repeats a kept one goes by its rank.
    kept = keyed.join(placed.select(MADE).join(stays, MADE, "left_anti"), MADE, "left_anti")
    return once(kept, found).select(docs.columns)


def once(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Of rows with the same id and text only one stays; those that occur once are not moved."""
    twice = found.groupBy(MADE).count().where("count > 1").select(MADE)
    single = docs.join(twice, MADE, "left_anti")
    return single.unionByName(docs.join(twice, MADE, "left_semi").dropDuplicates([MADE]))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    marked = with_contamination(docs, table(spark, sf_dir, "benchmark"), MADE)
    return marked.where(F.col(MADE)["n_hit"] == 0).drop(MADE)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = redacted(with_secrets(docs, MADE), MADE)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean.select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]

ORACLE_SQL = None  # SQL can express neither the classifier nor the tokenizer


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
