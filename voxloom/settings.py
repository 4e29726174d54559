"""One frozen bundle of settings, passed to the functions that need it."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    # cleaning
    comment_column: str = "customer_feedback"
    min_words: int = 3

    # vectors
    embedding: str = "e5large"
    embed_batch_size: int = 16
    hash_dims: int = 1024

    # clustering
    auto_params: bool = True
    reducer: str = "pca"  # or "umap", the non-linear layout
    layout_components: int = 5
    layout_min_dist: float = 0.0
    pca_components: int = 5
    neighbors: int = 30
    min_topic_size: int = 50
    min_samples: int | None = None
    kmeans_min_n: int = 1000
    kmeans_noise: float = 0.30
    seed: int = 42
    kmeans_restarts: int = 10

    # keywords and representatives
    min_df: int = 2
    ngram_max: int = 2
    top_keywords: int = 10
    rep_comments_min: int = 6
    rep_comments_max: int = 12
    normalize_stopwords: bool = False

    # analysis per topic
    analysis_enabled: bool = True
    analysis_model: str = "Qwen3-4B-Q4_K_M.gguf"
    samples_per_topic: int = 8
    max_retries: int = 1
    analysis_batch: int = 16  # topics whose answers are saved together

    # quality
    similar_threshold: float = 0.90
    tiny_share: float = 0.01
    tiny_floor: int = 5

    # validation preview
    validation_topics: int = 15
    validation_samples: int = 5

    # physical limits: a table above this many bytes is never broadcast
    broadcast_bytes: int = 32 * 1024 * 1024
    lookup_salts: int = 64


# Encoder keys and the model names they stand for.
EMBEDDING_MODELS = {
    "e5large": "intfloat/multilingual-e5-large",
    "e5base": "intfloat/multilingual-e5-base",
    "minilm": "sentence-transformers/paraphrase-multilingual-MiniLM-L12-v2",
}


def uses_query_prefix(settings: Settings) -> bool:
    """The e5 family expects every input to start with ``query: ``."""
    model = EMBEDDING_MODELS.get(settings.embedding, settings.embedding)
    return "e5" in settings.embedding.lower() or "e5" in model.lower()
