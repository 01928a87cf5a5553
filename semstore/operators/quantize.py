"""Scalar quantisation: vectors as signed bytes, searched coarsely and rescored exactly."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from semstore.errors import RecordError
from semstore.functions import vectors
from semstore.operators import ranking
from semstore.operators.filters import is_empty, predicate
from semstore.operators.records import select_ids
from semstore.operators.search import query_vector, score_column, search, shape
from semstore.plans import arguments, sizing

BINS = 65_536
LEVELS = 255


def bounds(coll: DataFrame, quantile: float = 0.99, vector_col: str = "vector") -> DataFrame:
    """One row ``low, high``: the middle ``quantile`` of all vector elements lies between them.

    Elements are counted in equal bins between the smallest and the largest one. The counts are formed per task
    and merged per bin; no task ever holds the elements, or a sketch of all of them.
    """
    if not 0 < quantile <= 1:
        raise RecordError("a quantile lies in (0, 1]")
    v = vectors.as_double(F.col(vector_col))
    ends = coll.select(F.array_min(v).alias("a"), F.array_max(v).alias("b"), F.size(v).alias("n"))
    ends = ends.agg(F.min("a").alias("a"), F.max("b").alias("b"), F.sum("n").alias("n"))
    ends = ends.select(F.struct("a", "b", "n")).scalar()
    elements = coll.select(F.explode(v).alias("x"), ends.alias("e"))
    width = (F.col("e")["b"] - F.col("e")["a"]) / BINS
    at = F.when(width > 0, F.least(F.floor((F.col("x") - F.col("e")["a"]) / width), F.lit(BINS - 1))).otherwise(0)
    counts = elements.groupBy(at.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    # At most BINS rows from here on.
    upto = F.sum("n").over(Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    ranked = counts.select("bin", upto.alias("upto"), ends.alias("e"))
    tail, total = (1 - quantile) / 2, F.col("e")["n"]
    edge = lambda bin_: F.col("e")["a"] + bin_ * width
    first = F.when(F.col("upto") >= F.greatest(total * tail, F.lit(1.0)), edge(F.col("bin")))
    last = F.when(F.col("upto") >= total * (1 - tail), edge(F.col("bin") + 1))
    return ranked.agg(F.min(first).alias("low"), F.min(last).alias("high"))


def encode(v: Column, low: Column, high: Column) -> Column:
    """Vector elements as bytes from -128 (``low`` and below) to 127 (``high`` and above)."""

    def level(x: Column) -> Column:
        steps = F.floor((x - low) / (high - low) * LEVELS + 0.5)
        return F.when(high > low, F.greatest(F.lit(0), F.least(steps, F.lit(LEVELS))) - 128).otherwise(-128).cast("tinyint")

    return F.transform(vectors.as_double(v), level)


def decode(code: Column, low: Column, high: Column) -> Column:
    return F.transform(code, lambda c: low + (c.cast("double") + 128) * ((high - low) / LEVELS))


def quantized(coll: DataFrame, bounds_row: DataFrame | None = None, *, quantile: float = 0.99,
              vector_col: str = "vector") -> DataFrame:
    """Add ``code`` and the bounds it was made with, ``code_low`` and ``code_high``."""
    found = (bounds(coll, quantile, vector_col) if bounds_row is None else bounds_row).select(F.struct("low", "high"))
    with_bounds = coll.select("*", found.scalar().alias("_b"))
    with_bounds = with_bounds.select(
        *coll.columns, F.col("_b")["low"].alias("code_low"), F.col("_b")["high"].alias("code_high")
    )
    return with_bounds.withColumn("code", encode(F.col(vector_col), F.col("code_low"), F.col("code_high")))


def quantized_search(
    coll: DataFrame,
    query,
    top_k: int | None = None,
    *,
    ignore: bool = False,
    rescore: bool = True,
    oversampling: float = 2.0,
    where: Mapping | None = None,
    metric: str = "cosine",
    id_col: str = "id",
    vector_col: str = "vector",
    **options,
) -> DataFrame:
    """Search on the byte codes; with ``rescore``, the best ``top_k x oversampling`` are ranked by exact scores.

    The first scan reads ids and codes only, an eighth of the vectors; ``ignore`` searches the vectors instead.
    """
    k = arguments.top_k(top_k)
    metric = vectors.check_metric(metric)
    hidden = [c for c in ("code", "code_low", "code_high") if c in coll.columns]
    plain = {"metric": metric, "id_col": id_col, "vector_col": vector_col, **options}
    if ignore:
        return search(coll.drop(*hidden), query, k, where=where, **plain)
    if oversampling < 1:
        raise RecordError("oversampling must be at least 1")
    taken = max(k, int(k * oversampling)) if rescore else k
    query = query_vector(query)
    chosen = coll if is_empty(where) else coll.where(predicate(coll, where))
    approximate = chosen.withColumn("_near", decode(F.col("code"), F.col("code_low"), F.col("code_high")))
    coarse = shape(
        approximate.withColumn("score", score_column(query, metric, F.col("_near"))),
        id_col=id_col,
        vector_col=vector_col,
        with_payload=not rescore and options.get("with_payload", True),
        hidden=(*hidden, "_near"),
    )
    best = ranking.best(coarse, taken, metric, id_col, sizing.scan_tasks(coll))
    if not rescore:
        return best
    # The number of candidates is fixed by the caller, so their ids may go to every task when they are few.
    ids = best.select(id_col)
    ids = F.broadcast(ids) if taken <= 10_000 else ids
    return search(select_ids(coll.drop(*hidden), ids, id_col=id_col), query, k, **plain)
