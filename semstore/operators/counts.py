"""Counts and summaries of a collection."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from semstore.errors import EmbeddingError, RecordError
from semstore.operators.filters import is_empty, predicate
from semstore.plans import arguments


def count_records(coll: DataFrame, where: Mapping | None = None, *, exact: bool = True, id_col: str = "id") -> DataFrame:
    """One row ``count``. Inexact counting estimates the number of distinct ids, so it takes duplicates in its stride."""
    chosen = coll if is_empty(where) else coll.where(predicate(coll, where))
    number = F.count(F.lit(1)) if exact else F.approx_count_distinct(id_col, 0.01)
    return chosen.agg(number.alias("count"))


def count_memory(
    coll: DataFrame, where: Mapping | None = None, *, exact: bool = False, collection: str | None = None,
    id_col: str = "id",
) -> DataFrame:
    """Count with checked arguments: ``count, collection, has_filter, exact``."""
    where = arguments.filter_dict(where)
    name = arguments.collection_name(collection)
    if not isinstance(exact, bool):
        raise RecordError("exact must be a boolean")
    return count_records(coll, where, exact=exact, id_col=id_col).select(
        "count",
        F.lit(name).alias("collection"),
        F.lit(not is_empty(where)).alias("has_filter"),
        F.lit(exact).alias("exact"),
    )


def embedding_totals(embedded: DataFrame) -> DataFrame:
    """How many texts were embedded and how many failed."""
    return embedded.agg(F.count("vector").alias("success_count"), F.count("error").alias("failure_count"))


def dimensions(coll: DataFrame, *, id_col: str = "id", vector_col: str = "vector") -> DataFrame:
    """The dimension of the first record, the range over all, and the first record that differs.

    First means smallest id. The differing record is found by keeping the smallest id per dimension.
    """
    per_size = coll.groupBy(F.size(vector_col).alias("dim")).agg(
        F.count(F.lit(1)).alias("n"), F.min(id_col).alias("first_id")
    )
    # One row per distinct dimension from here on.
    summary = per_size.agg(
        F.sum("n").alias("records"),
        F.min_by("dim", "first_id").alias("expected_dim"),
        F.min("dim").alias("min_dim"),
        F.max("dim").alias("max_dim"),
        F.collect_list(F.struct("first_id", "dim")).alias("sizes"),
    )
    others = F.array_sort(F.filter("sizes", lambda s: s["dim"] != F.col("expected_dim")))
    first = F.get(others, F.lit(0))
    return summary.select(
        F.coalesce("records", F.lit(0)).alias("records"), "expected_dim", "min_dim", "max_dim",
        first["first_id"].alias("offender_id"), first["dim"].alias("offender_dim"),
    )


def require_one_dimension(coll: DataFrame, *, id_col: str = "id", vector_col: str = "vector") -> None:
    """Raise, naming the first record whose vector has another dimension than the first one."""
    row = dimensions(coll, id_col=id_col, vector_col=vector_col).first()
    if row["offender_id"] is not None:
        raise EmbeddingError(
            f"expected dimension {row['expected_dim']}, got {row['offender_dim']} in record {row['offender_id']}"
        )


def describe(coll: DataFrame, name: str, dim: int, metric: str, vector_col: str = "vector") -> DataFrame:
    """One row: name, status, declared dimension and metric, record count and the dimensions found."""
    found = coll.agg(
        F.count(F.lit(1)).alias("records"),
        F.min(F.size(vector_col)).alias("min_dim"),
        F.max(F.size(vector_col)).alias("max_dim"),
    )
    sound = F.coalesce((F.col("min_dim") == dim) & (F.col("max_dim") == dim), F.lit(True))
    return found.select(
        F.lit(name).alias("name"),
        F.when(sound, "green").otherwise("red").alias("status"),
        F.lit(dim).alias("dim"),
        F.lit(metric).alias("metric"),
        "records", "min_dim", "max_dim",
    )
