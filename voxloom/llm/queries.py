"""The registered queries of the corpus operators, with production parameters over whole tables."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.llm.alignment import aligned
from voxloom.llm.common import held_out, table, texts
from voxloom.llm.decontamination import with_contamination
from voxloom.llm.jaccard_join import jaccard_components
from voxloom.llm.language import train, with_language
from voxloom.llm.packing import packed
from voxloom.llm.prefix_trie import trie
from voxloom.llm.quality import with_quality
from voxloom.llm.secrets import KINDS, with_secrets
from voxloom.llm.sql import ORACLE_SQL  # noqa: F401  read by the entry point
from voxloom.llm.suffix_dedup import deduplicated
from voxloom.llm.token_files import read_token_files, write_token_files
from voxloom.llm.toxicity import with_toxicity
from voxloom.llm.url_filters import judged
from voxloom.llm.vantage_tree import nearest
from voxloom.session import scratch_path


# The rules of the query: the end of a host, a slash and the beginning of a path.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages"), RULES)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(table(spark, sf_dir, "documents")).drop("spans")


def op3_vantage_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10, factor=1.1)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where(~held_out())
    scored = with_toxicity(texts(table(spark, sf_dir, "documents")), labels, "score")
    predicted = (F.col("score") >= 0.7).cast("int").alias("predicted")
    return scored.select("doc_id", held_out().alias("held_out"), "score", predicted)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_token_files(spark, path)


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = with_contamination(texts(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"), "found")
    return marked.select(
        "doc_id",
        "found.n_words",
        "found.n_hit",
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("found.items")), 256).alias("items_sha256"),
        (F.col("found.n_hit") > 0).alias("contaminated"),
    )


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packed(table(spark, sf_dir, "documents"), path, with_ids=False)


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    network = train(texts(docs, "lang").where(~held_out()))
    found = with_language(texts(docs), network, "found")
    return found.select(
        "doc_id", held_out().alias("held_out"), F.col("found.lang").alias("lang_pred"), F.col("found.score")
    )


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_secrets(texts(table(spark, sf_dir, "documents")), "found")
    base, every = F.col("found.base"), F.concat("found.base", "found.novel")
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long")
    # KINDS are listed in the order assign, access, hex, novel.
    order = lambda s: F.array_position(F.array(*map(F.lit, KINDS)), s["kind"])
    shown = lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])
    joined = lambda spans: F.array_join(
        F.transform(
            F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], order(s), shown(s).alias("shown")))),
            lambda s: s["shown"],
        ),
        ",",
    )
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(every).alias("spans"),
    )


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"), heads=9, every=5)


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = texts(table(spark, sf_dir, "documents"))
    scored = with_quality(docs, table(spark, sf_dir, "labels").where(~held_out()), docs.where(~held_out()), "score")
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", held_out().alias("held_out"), "score", predicted)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return aligned(table(spark, sf_dir, "documents"), *paths)[0]


QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_url_filters": op1_url_filters,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_vantage_tree": op3_vantage_tree,
    "op4_toxicity": op4_toxicity,
    "op5_token_files": op5_token_files,
    "op6_decontamination": op6_decontamination,
    "op7_packing": op7_packing,
    "op8_language": op8_language,
    "op9_secrets": op9_secrets,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_quality": op12_quality,
    "op13_alignment": op13_alignment,
}
