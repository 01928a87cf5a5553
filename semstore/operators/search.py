"""Similarity search for one query vector or text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from semstore.errors import RecordError
from semstore.functions import text as texts
from semstore.functions import vectors
from semstore.operators import ranking
from semstore.operators.filters import is_empty, predicate
from semstore.plans import arguments, sizing

Query = Sequence[float] | DataFrame


def query_vector(query: Query) -> list[float]:
    """The vector to search for; a one-row DataFrame is read here and now.

    As a literal it is part of the scoring expression. As a subquery it would be copied into every row, because a
    higher-order function takes none, and scoring would take half as long again.
    """
    if isinstance(query, DataFrame):
        if len(query.columns) != 1:
            raise RecordError("a query DataFrame must have the vector as its only column")
        rows = query.limit(2).collect()
        if not rows or rows[0][0] is None:
            raise RecordError("the query vector was not found")
        if len(rows) > 1:
            raise RecordError("a query DataFrame must have one row")
        query = rows[0][0]
    return vectors.as_vector(query)


def score_column(query: Query, metric: str, vector: Column, known_norm: Column | None = None) -> Column:
    numbers = query_vector(query)
    return vectors.score(metric, vector, vectors.literal(numbers), known_norm, F.lit(vectors.py_norm(numbers)))


def scored(
    coll: DataFrame,
    query: Query,
    *,
    where: Mapping | None = None,
    metric: str = "cosine",
    vector_col: str = "vector",
    norm_col: str | None = None,
) -> DataFrame:
    """The records that pass the filter, all columns kept, with their ``score``."""
    value = score_column(query, metric, F.col(vector_col), F.col(norm_col) if norm_col else None)
    chosen = coll if is_empty(where) else coll.where(predicate(coll, where))
    return chosen.withColumn("score", value)


def shape(
    df: DataFrame,
    *,
    id_col: str,
    vector_col: str,
    with_vector: bool = False,
    with_payload: bool = True,
    hidden: Sequence[str | None] = (),
) -> DataFrame:
    """Id and score, then the payload and the vector as asked for."""
    lead = [c for c in ("query_id", id_col, "score", "rank") if c in df.columns]
    rest = [c for c in df.columns if c not in (*lead, vector_col, *hidden)]
    return df.select(*lead, *(rest if with_payload else []), *([vector_col] if with_vector else []))


def search(
    coll: DataFrame,
    query: Query,
    top_k: int | None = None,
    *,
    where: Mapping | None = None,
    metric: str = "cosine",
    score_threshold: float | None = None,
    id_col: str = "id",
    vector_col: str = "vector",
    norm_col: str | None = None,
    with_vector: bool = False,
    with_payload: bool = True,
) -> DataFrame:
    """The nearest records to one vector, best first.

    The filter reaches the scan; each record is scored once; every task sends on its k best only.
    """
    k = arguments.top_k(top_k)
    metric = vectors.check_metric(metric)
    rows = scored(coll, query, where=where, metric=metric, vector_col=vector_col, norm_col=norm_col)
    rows = shape(
        rows,
        id_col=id_col,
        vector_col=vector_col,
        with_vector=with_vector,
        with_payload=with_payload,
        hidden=(norm_col,),
    )
    found = ranking.best(rows, k, metric, id_col, sizing.scan_tasks(coll))
    # After the limit: before it, the optimizer would compute the score a second time for the filter.
    return found if score_threshold is None else found.where(ranking.beyond(metric, score_threshold))


def rank_all(
    coll: DataFrame,
    query: Query,
    *,
    metric: str = "cosine",
    id_col: str = "id",
    vector_col: str = "vector",
    where: Mapping | None = None,
) -> DataFrame:
    """Every record, ordered by similarity to one vector."""
    metric = vectors.check_metric(metric)
    rows = scored(coll, query, where=where, metric=metric, vector_col=vector_col)
    return shape(rows, id_col=id_col, vector_col=vector_col).orderBy(*ranking._order(metric, id_col))


def search_text(coll: DataFrame, text: str, provider, top_k: int | None = None, **options) -> DataFrame:
    """Embed a text, then search for its vector."""
    query = provider.embed_one(coll.sparkSession, arguments.query_text(text))
    return search(coll, query, top_k, **options)


def result_text(df: DataFrame) -> Column:
    """The text of a record, from the string-typed fields that may hold one."""
    strings = {f.name: F.col(f"`{f.name}`") for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return texts.first_text(strings)


def search_memory(
    coll: DataFrame,
    query: str,
    provider,
    top_k: int | None = None,
    where: Mapping | None = None,
    *,
    id_col: str = "id",
    vector_col: str = "vector",
    **options,
) -> DataFrame:
    """Text search with checked arguments: ``id, score, payload, text, total_results, has_filter``."""
    k = arguments.tool_top_k(top_k)
    where = arguments.filter_dict(where)
    text = arguments.query_text(query, arguments.MAX_QUERY_LENGTH)
    found = search_text(coll, text, provider, k, where=where, id_col=id_col, vector_col=vector_col, **options)
    payload = [F.col(f"`{c}`") for c in found.columns if c not in (id_col, "score")]
    return found.select(
        id_col,
        "score",
        (F.struct(*payload) if payload else F.lit(None)).alias("payload"),
        result_text(found).alias("text"),
        # At most k rows come this far.
        F.expr("count(1) OVER ()").alias("total_results"),
        F.lit(not is_empty(where)).alias("has_filter"),
    )
