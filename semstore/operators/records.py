"""Upsert, look-up, deletion, update and paging as DataFrame transformations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from semstore.errors import RecordError
from semstore.operators.filters import is_empty, predicate
from semstore.plans import arguments, sizing

Ids = Sequence | DataFrame
#: Ids that a filter of the scan compares one by one.
_FEW = 10


def latest(batch: DataFrame, newest_first: Sequence[Column], id_col: str = "id") -> DataFrame:
    """One record per id, the newest. Spark keeps one row per id and task before it shuffles."""
    window = Window.partitionBy(id_col).orderBy(*newest_first)
    return batch.withColumn("_nth", F.row_number().over(window)).where(F.col("_nth") == 1).drop("_nth")


def upsert(base: DataFrame, batch: DataFrame, id_col: str = "id") -> DataFrame:
    """Replace whole records by id and add new ones. ``batch`` holds each id once."""
    kept = base.join(batch.select(id_col), id_col, "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True)


def _ids_of(df: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    if len(ids.columns) != 1:
        raise RecordError("a DataFrame of ids has one column")
    return ids.select(F.col(ids.columns[0]).cast(df.schema[id_col].dataType).alias(id_col))


def _literals(df: DataFrame, ids: Sequence, id_col: str) -> list:
    """Ids given in a list, trimmed, in the type of the column; what cannot be in it is left out."""
    wanted = arguments.record_ids(ids)
    if not isinstance(df.schema[id_col].dataType, T.IntegralType):
        return wanted
    return [int(v) for v in wanted if v.lstrip("-").isdigit() and str(int(v)) == v]


def select_ids(df: DataFrame, ids: Ids, *, id_col: str = "id", keep: bool = True) -> DataFrame:
    """The records with the given ids, or all others. A short list reaches the scan as literals."""
    if isinstance(ids, DataFrame):
        return df.join(_ids_of(df, ids, id_col), id_col, "left_semi" if keep else "left_anti")
    wanted = _literals(df, ids, id_col)
    if len(wanted) > sizing.LITERAL_IDS:
        table = df.sparkSession.createDataFrame([(v,) for v in wanted], T.StructType([df.schema[id_col]]))
        return select_ids(df, table, id_col=id_col, keep=keep)
    field = F.col(id_col)
    found = field.isin(wanted) if wanted else F.lit(False)
    if keep and len(wanted) > _FEW:
        # The scan is told of longer lists only from where to where they reach, of short ones every id.
        wanted = sorted(wanted)
        found = found & reduce(or_, [field.isin(wanted[i : i + _FEW]) for i in range(0, len(wanted), _FEW)])
    return df.where(found if keep else ~found)


def get_by_ids(
    coll: DataFrame,
    ids: Ids,
    *,
    with_payload: bool = True,
    with_vector: bool = False,
    id_col: str = "id",
    vector_col: str = "vector",
) -> DataFrame:
    """Records by id, with score 0; unknown ids are simply missing."""
    found = select_ids(coll, ids, id_col=id_col)
    payload = [c for c in coll.columns if c not in (id_col, vector_col)] if with_payload else []
    vector = [vector_col] if with_vector and vector_col in coll.columns else []
    return found.select(id_col, F.lit(0.0).alias("score"), *payload, *vector)


def existing_flags(batch: DataFrame, coll: DataFrame | None, flag: str = "was_update", id_col: str = "id") -> DataFrame:
    """Mark which rows of a batch name a record that exists; none do when there is no collection."""
    if coll is None:
        return batch.withColumn(flag, F.lit(False))
    # Only the ids of the batch are kept before the duplicates go, so no shuffle sees the whole collection.
    known = coll.select(id_col).join(batch.select(id_col), id_col, "left_semi").distinct()
    known = known.withColumn(flag, F.lit(True))
    return batch.join(known, id_col, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def delete_by_ids(coll: DataFrame, ids: Ids, id_col: str = "id") -> DataFrame:
    """The records that stay; unknown ids do nothing."""
    return select_ids(coll, ids, id_col=id_col, keep=False)


def _needed(flt: Mapping | None) -> Mapping:
    if is_empty(flt):
        raise RecordError("a filter is needed to change records")
    return flt


def delete_by_filter(coll: DataFrame, where: Mapping) -> DataFrame:
    """The records that stay when those matching the filter go."""
    return coll.where(~predicate(coll, _needed(where)))


def update_payload(coll: DataFrame, where: Mapping, values: Mapping[str, Any]) -> DataFrame:
    """Set payload columns on the records that match; a new column is NULL elsewhere."""
    if not values:
        raise RecordError("there is nothing to set")
    match = predicate(coll, _needed(where))
    types = {f.name: f.dataType for f in coll.schema.fields}
    changed = {}
    for name, value in values.items():
        new = F.lit(value)
        old = F.col(f"`{name}`") if name in types else F.lit(None)
        changed[name] = F.when(match, new.cast(types[name]) if name in types else new).otherwise(old)
    return coll.withColumns(changed)


def scroll(
    coll: DataFrame,
    *,
    where: Mapping | None = None,
    limit: int | None = None,
    offset: Any = None,
    with_payload: bool = True,
    with_vector: bool = False,
    id_col: str = "id",
    vector_col: str = "vector",
) -> DataFrame:
    """One page in id order, after the id ``offset``; the last id of a page is the next offset."""
    size = arguments.top_k(limit)
    page = coll if is_empty(where) else coll.where(predicate(coll, where))
    if offset is not None:
        page = page.where(F.col(id_col) > F.lit(offset))
    payload = [c for c in coll.columns if c not in (id_col, vector_col)] if with_payload else []
    vector = [vector_col] if with_vector and vector_col in coll.columns else []
    return page.select(id_col, *payload, *vector).orderBy(id_col).limit(size)
