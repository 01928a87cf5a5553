"""The known embedding models: dimensions, limits and prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from semstore.errors import EmbeddingError

# Fixed values: (model, dimensions, max_tokens, supports_dimensions, price per 1,000 tokens)
MODELS = (
    ("text-embedding-3-small", 1536, 8191, True, 0.00002),
    ("text-embedding-3-large", 3072, 8191, True, 0.00013),
    ("text-embedding-ada-002", 1536, 8191, False, 0.0001),
    ("nomic-embed-text", 768, 8192, None, None),
    ("mxbai-embed-large", 1024, 512, None, None),
    ("all-minilm", 384, 256, None, None),
)
MODEL_SCHEMA = "model string, dimensions int, max_tokens int, supports_dimensions boolean, price_per_1k double"


def catalog(spark: SparkSession) -> DataFrame:
    """The six known models as a table, always small enough to broadcast."""
    return spark.createDataFrame(list(MODELS), MODEL_SCHEMA)


def with_model(df: DataFrame, model: str | Column) -> DataFrame:
    """Attach the facts of a model to every row; unknown models give NULLs."""
    if isinstance(model, str):
        known = {row[0]: row[1:] for row in MODELS}.get(model, (None,) * 4)
        types = ("int", "int", "boolean", "double")
        names = ("dimensions", "max_tokens", "supports_dimensions", "price_per_1k")
        facts = [F.lit(v).cast(t).alias(n) for v, t, n in zip(known, types, names, strict=True)]
        return df.select("*", F.lit(model).alias("model"), *facts)
    return df.withColumn("model", model).join(F.broadcast(catalog(df.sparkSession)), "model", "left")


def estimated_tokens(length: Column) -> Column:
    return F.ceil(length / 4)


def estimated_cost(length: Column, price_per_1k: Column) -> Column:
    return estimated_tokens(length) / 1000 * price_per_1k


def expected_dimensions(model: str, override: int | None = None) -> int | None:
    """The dimension a model yields: an override, else the catalog's value, else None."""
    known = {row[0]: row for row in MODELS}.get(model)
    if override is None:
        return known[1] if known else None
    if override <= 0:
        raise EmbeddingError("dimensions must be a positive number")
    if known and not known[3]:
        raise EmbeddingError(f"model {model} has no choice of dimensions")
    return override
