"""The best k rows: overall, and per query."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from semstore.functions.vectors import ASCENDING
from semstore.plans import sizing


def _order(metric: str, id_col: str) -> list[Column]:
    score = F.col("score").asc() if metric in ASCENDING else F.col("score").desc()
    return [score, F.col(id_col).asc()]


def beyond(metric: str, threshold: float | Column) -> Column:
    """Scores at least as good as a threshold."""
    return F.col("score") <= threshold if metric in ASCENDING else F.col("score") >= threshold


def _merge_first(scored: DataFrame, k: int, tasks: int, keys: list[str], order: list[Column], place) -> DataFrame:
    """Merge the winners of neighbouring tasks before the last step, where one task would see too many.

    The tasks are spread over about sqrt(tasks) mergers; Spark cuts each task's rows to k before this shuffle.
    """
    limit = int(scored.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if tasks * k <= sizing.MERGE_ROWS or k > limit:
        return scored
    mergers = math.isqrt(tasks) + 1
    window = Window.partitionBy(*keys, "_merger").orderBy(*order)
    placed = scored.withColumn("_merger", F.spark_partition_id() % mergers).withColumn("_place", place().over(window))
    return placed.where(F.col("_place") <= k).drop("_merger", "_place")


def best(scored: DataFrame, k: int, metric: str, id_col: str, tasks: int) -> DataFrame:
    """The k best rows of all, best first; ties go to the smaller id."""
    order = _order(metric, id_col)
    return _merge_first(scored, k, tasks, [], order, F.row_number).orderBy(*order).limit(k)


def best_per_query(
    scored: DataFrame, k: int, metric: str, id_col: str, tasks: int, *, repeated: bool = False
) -> DataFrame:
    """The k best rows of every query, with their rank from 1.

    With ``repeated``, the same record may come several times with one score; it gets one place and is kept once.
    """
    order = _order(metric, id_col)
    place = F.dense_rank if repeated else F.row_number
    window = Window.partitionBy("query_id").orderBy(*order)
    merged = _merge_first(scored, k, tasks, ["query_id"], order, place)
    ranked = merged.withColumn("rank", place().over(window)).where(F.col("rank") <= k)
    # The rows lie together by query already, so this needs no further shuffle.
    return ranked.dropDuplicates(["query_id", id_col]) if repeated else ranked
