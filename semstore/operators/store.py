"""Texts to records: check, enrich, embed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from semstore.functions import text as texts
from semstore.operators.embed import Provider, embed
from semstore.operators.quality import REASON, store_reason
from semstore.plans import sizing

ADDED = ("_stored_at", "_text_length", "_word_count", "_analysis")


def _truthy(field: Column, data_type: T.DataType) -> Column:
    """Whether a payload value counts as present: neither missing, nor empty, nor zero, nor false."""
    if isinstance(data_type, T.StringType):
        present = field != ""
    elif isinstance(data_type, T.BooleanType):
        present = field
    elif isinstance(data_type, T.NumericType):
        present = (field != 0) & ~F.isnan(field.cast("double"))
    else:
        present = field.isNotNull()
    return F.coalesce(present, F.lit(False))


def enrich(
    docs: DataFrame, *, text_col: str = "text", payload: Sequence[str] = (), stored_at: Column | None = None
) -> DataFrame:
    """Add what is kept with a text: the text itself under ``text``, the time, the length and the analysis.

    The text is left out where the payload already has a ``text`` or a ``content``.
    """
    t = F.col(text_col)
    types = {f.name: f.dataType for f in docs.schema.fields}
    own = [_truthy(F.col(c), types[c]) for c in ("text", "content") if c in payload]
    own_text = F.col("text") if "text" in payload else F.lit(None).cast("string")
    kept_text = F.when(reduce(lambda a, b: a | b, own), own_text).otherwise(t) if own else t
    analysed = docs.select(
        *[c for c in docs.columns if c not in (*ADDED, "text")],
        kept_text.alias("text"),
        (F.current_timestamp() if stored_at is None else stored_at).alias("_stored_at"),
        texts.is_blank(t).alias("_blank"),
        texts.analysis(t).alias("_analysis"),
    )
    # A blank text has one empty word in the analysis, and none in the count beside it.
    words = F.when(F.col("_blank"), 0).otherwise(F.col("_analysis.word_count"))
    return analysed.select(
        *[c for c in analysed.columns if c not in ("_blank", "_analysis")],
        F.col("_analysis.character_count").alias("_text_length"),
        words.alias("_word_count"),
        "_analysis",
    )


def payload_keys(df: DataFrame, names: Sequence[str]) -> Column:
    """The names of the payload fields a record has, a NULL column being a missing key."""
    return F.array_compact(F.array(*[F.when(F.col(f"`{c}`").isNotNull(), F.lit(c)) for c in names]))


#: The place of a row among those of its id; the greatest wins.
ORDER = "_order"


def _ordered(docs: DataFrame, order_by: Sequence[Column]) -> DataFrame:
    return docs.withColumn(ORDER, F.struct(*order_by)) if order_by else docs


def _order_column(order_by: Sequence[Column]) -> list[str]:
    return [ORDER] if order_by else []


def store_texts(
    docs: DataFrame,
    provider: Provider,
    *,
    id_col: str = "id",
    text_col: str = "text",
    payload: Sequence[str] = (),
    order_by: Sequence[Column] = (),
) -> DataFrame:
    """Plain records ``id, vector, payload..., error``; the untrimmed text is embedded, the id is trimmed."""
    made = embed(_ordered(docs, order_by), provider, text_col)
    id_ = F.col(id_col).cast("string")
    reason = F.when(texts.is_blank(id_), F.lit("id_blank"))
    return made.select(
        texts.trim(id_).alias("id"), "vector", *payload, *_order_column(order_by), F.coalesce(reason, F.col("error")).alias(REASON)
    )


def store_memories(
    docs: DataFrame,
    provider: Provider,
    *,
    id_col: str = "id",
    text_col: str = "text",
    payload: Sequence[str] = (),
    stored_at: Column | None = None,
    order_by: Sequence[Column] = (),
) -> DataFrame:
    """Enriched records ``id, vector, payload..., text, _stored_at ..., reject_reason``, one embedding per text."""
    docs = _ordered(sizing.spread(docs), order_by)
    given = F.struct(*payload) if payload else None
    # The text to embed goes under a name of its own: "text" may be a payload field as well.
    marked = docs.select(
        F.col(id_col).cast("string").alias("id"),
        F.col(text_col).alias("_source"),
        *[c for c in payload if c != "id"],
        *_order_column(order_by),
        store_reason(F.col(id_col), F.col(text_col), given).alias(REASON),
    )
    # enriched behind the provider, which so gets each text once and none of what is measured of it
    made = enrich(embed(marked, provider, "_source", spread=False), text_col="_source", payload=payload, stored_at=stored_at)
    names = [c for c in payload if c not in ("id", "text")]
    return made.select(
        texts.trim(F.col("id")).alias("id"),
        "vector",
        *names,
        "text",
        *ADDED,
        *_order_column(order_by),
        F.coalesce(REASON, "error").alias(REASON),
    )


def store_report(records: DataFrame, flag: str = "was_update") -> DataFrame:
    """What is reported per stored text, with the flag if the records have it already."""
    inner = ("id", "vector", flag, REASON, ORDER)
    keys = payload_keys(records, [c for c in records.columns if c not in inner])
    return records.select(
        "id",
        F.size("vector").alias("vector_dimensions"),
        *[c for c in (flag,) if c in records.columns],
        F.col("_text_length").alias("text_length"),
        keys.alias("payload_keys"),
    )
