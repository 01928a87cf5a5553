"""Search near some records and away from others."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from semstore.errors import RecordError
from semstore.functions import vectors
from semstore.operators.records import select_ids
from semstore.operators.search import search

Ids = Sequence | DataFrame


def mean_vector(df: DataFrame, vector_col: str = "vector") -> DataFrame:
    """The element-wise mean as a one-row DataFrame; summed per position before anything is shuffled."""
    elements = df.select(F.posexplode(vectors.as_double(F.col(vector_col))).alias("pos", "x"))
    means = elements.groupBy("pos").agg(F.avg("x").alias("x"))
    # One row per dimension is left here.
    ordered = means.agg(F.array_sort(F.collect_list(F.struct("pos", "x"))).alias("e"))
    return ordered.select(F.when(F.size("e") > 0, F.col("e")["x"]).alias("vector"))


def recommend(
    coll: DataFrame,
    positive: Ids,
    negative: Ids | None = None,
    top_k: int | None = None,
    *,
    where: Mapping | None = None,
    metric: str = "cosine",
    id_col: str = "id",
    vector_col: str = "vector",
    **options,
) -> DataFrame:
    """Search for ``mean(positive) + (mean(positive) - mean(negative))``; the examples are left out."""
    if not isinstance(positive, DataFrame) and not positive:
        raise RecordError("at least one positive example is needed")
    if negative is not None and not isinstance(negative, DataFrame) and not negative:
        negative = None

    target = _mean(coll, positive, id_col, vector_col)
    if target is None:
        raise RecordError("none of the positive examples was found")
    others = select_ids(coll, positive, id_col=id_col, keep=False)
    if negative is not None:
        away = _mean(coll, negative, id_col, vector_col)
        target = target if away is None else [p + (p - n) for p, n in zip(target, away, strict=True)]
        others = select_ids(others, negative, id_col=id_col, keep=False)
    return search(
        others, target, top_k, where=where, metric=metric, id_col=id_col, vector_col=vector_col, **options
    )


def _mean(coll: DataFrame, ids: Ids, id_col: str, vector_col: str) -> list[float] | None:
    return mean_vector(select_ids(coll, ids, id_col=id_col), vector_col).first()["vector"]
