"""Which records and texts may be stored, as a reason column and a split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from semstore.errors import RecordError
from semstore.functions import text as texts
from semstore.functions import vectors

# Limits in UTF-16 units, for callers that want them; none holds by default.
MAX_ID_LENGTH = 512
MAX_EMBED_LENGTH = 100_000
MAX_STORE_LENGTH = 1_000_000
MAX_PAYLOAD_LENGTH = 100_000

REASON = "reject_reason"


def _first(*rules: tuple[Column, str]) -> Column:
    """The name of the first rule broken, or NULL."""
    return F.coalesce(*[F.when(broken, F.lit(name)) for broken, name in rules])


def record_reason(
    *, dim: int | None = None, check_elements: bool = True, id_col: str = "id", vector_col: str = "vector"
) -> Column:
    """Id, vector, elements and dimension of a record."""
    v = F.col(vector_col)
    rules = [
        (texts.is_blank(F.col(id_col).cast("string")), "id_blank"),
        (v.isNull() | (F.size(v) < 1), "vector_empty"),
    ]
    if check_elements:
        rules.append((vectors.has_bad_element(v), "vector_not_finite"))
    if dim is not None:
        rules.append((F.size(v) != dim, "dimension_mismatch"))
    return _first(*rules)


def text_reason(text: Column, max_length: int | None = None) -> Column:
    """A text that can be embedded: not blank, and not longer than a limit if one is given."""
    return _first((texts.is_blank(text), "text_blank"), *_longer(text, max_length, "text_too_long_to_embed"))


def _longer(text: Column, limit: int | None, name: str) -> list[tuple[Column, str]]:
    return [] if limit is None else [(texts.longer_than(text, limit), name)]


def store_reason(
    id_: Column,
    text: Column,
    payload: Column | None = None,
    *,
    max_id: int | None = None,
    max_text: int | None = None,
    max_payload: int | None = None,
) -> Column:
    """Id, text and payload of a text to be stored. ``payload`` is a struct or a VARIANT; limits hold where given."""
    id_ = id_.cast("string")
    rules = [
        (texts.is_blank(id_), "id_blank"),
        *_longer(id_, max_id, "id_too_long"),
        (texts.is_blank(text), "text_blank"),
        *_longer(text, max_text, "text_too_long"),
    ]
    if payload is not None and max_payload is not None:
        rules += _longer(F.to_json(payload), max_payload, "payload_too_large")
    return _first(*rules)


def document_reason(payload: Column | None = None, *, id_col: str = "id", vector_col: str = "vector") -> Column:
    """A complete document: a sound record whose VARIANT payload, if any, is an object."""
    rules = [record_reason(id_col=id_col, vector_col=vector_col)]
    if payload is not None:
        kind = F.schema_of_variant(payload)
        rules.append(F.when(payload.isNotNull() & ~kind.startswith("OBJECT<"), F.lit("payload_not_an_object")))
    return F.coalesce(*rules)


def split_valid(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """The rows without a reason, and the others with it in ``reject_reason``."""
    marked = df.withColumn(REASON, reason)
    return marked.where(F.col(REASON).isNull()).drop(REASON), marked.where(F.col(REASON).isNotNull())


def require_valid(rejects: DataFrame, id_col: str = "id") -> None:
    """Raise when anything was rejected: all or nothing."""
    found = rejects.select(F.col(id_col).cast("string"), REASON).limit(1).collect()
    if found:
        raise RecordError(f"record {found[0][0]!r} is not acceptable: {found[0][1]}")
