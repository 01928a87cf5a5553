"""Semantic memory on Spark: records with vectors, kept in tables, searched by similarity."""

from semstore.errors import EmbeddingError, FilterError, RecordError, SemstoreError
from semstore.operators.filters import FilterBuilder, new_filter
from semstore.sources.collection import Collection

__all__ = [
    "Collection",
    "EmbeddingError",
    "FilterBuilder",
    "FilterError",
    "RecordError",
    "SemstoreError",
    "new_filter",
]
