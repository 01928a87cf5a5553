"""Similarity of given pairs of records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from semstore.functions import vectors
from semstore.plans import sizing


def pair_similarity(
    pairs: DataFrame, coll: DataFrame, *, metric: str = "cosine", id_col: str = "id", vector_col: str = "vector"
) -> DataFrame:
    """``id_a, id_b, score`` for the pairs asked for; pairs with an unknown id drop out.

    Two joins on the record id, which is unique in the collection: no pair is made up along the way. A record
    named by very many pairs skews the pairs' side only, which adaptive execution splits. Where the ids named are few
    enough to be broadcast but the vectors are not, the vectors of no other record are shuffled.
    """
    metric = vectors.check_metric(metric)
    most = sizing.RESULT_BROADCAST_BYTES
    if sizing.estimated_bytes(pairs.select("id_a", "id_b")) <= most < sizing.estimated_bytes(coll.select(id_col, vector_col)):
        named = pairs.select(F.explode(F.array("id_a", "id_b")).alias(id_col)).distinct()
        coll = coll.join(F.broadcast(named), id_col, "left_semi")
    side = lambda s: coll.select(F.col(id_col).alias(f"id_{s}"), F.col(vector_col).alias(f"_v_{s}"))
    both = pairs.select("id_a", "id_b").join(side("a"), "id_a").join(side("b"), "id_b")
    return both.select("id_a", "id_b", vectors.score(metric, F.col("_v_a"), F.col("_v_b")).alias("score"))
