"""Hot payload fields as typed columns beside the VARIANT payload, so that filters on them reach the scan.

A promoted field has four columns: its text, its number and its truth value, each null where the field is of another
kind, and `rest`, true where only the payload knows (an array or an object) and null where the columns say nothing (they
were not made, or the number is NaN).
Filters ask the columns, and the payload for the rows that these leave open (see `filters.predicate`).
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from semstore.errors import RecordError
from semstore.operators import filters

_PLAIN = re.compile(r"[A-Za-z0-9_]+")


def check_fields(fields: Iterable[str]) -> list[str]:
    """Names that can be promoted: letters, digits and underscores."""
    names = list(dict.fromkeys(fields))
    wrong = [n for n in names if not isinstance(n, str) or not _PLAIN.fullmatch(n)]
    if wrong or not names:
        raise RecordError(f"fields to promote are named by letters, digits and underscores, not {wrong!r}")
    return names


def schema(fields: Iterable[str]) -> list[T.StructField]:
    """The columns of promoted fields."""
    kinds = {"text": T.StringType(), "number": T.DoubleType(), "boolean": T.BooleanType(), "rest": T.BooleanType()}
    return [T.StructField(filters.promoted(kind, name), type_) for name in fields for kind, type_ in kinds.items()]


def columns(fields: Iterable[str], payload: str = "payload") -> dict[str, Column]:
    """The columns of promoted fields, from the payload."""
    made = {}
    for name in fields:
        value = F.try_variant_get(F.col(payload), filters._path(name), "variant")
        kind = F.schema_of_variant(value)
        made[filters.promoted("text", name)] = F.when(kind == "STRING", F.try_variant_get(value, "$", "string"))
        number = filters._variant_number(value)
        made[filters.promoted("number", name)] = F.when(~F.isnan(number), number)
        made[filters.promoted("boolean", name)] = F.when(kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean"))
        compound = F.coalesce(kind.startswith("ARRAY<") | kind.startswith("OBJECT<"), F.lit(False))
        made[filters.promoted("rest", name)] = F.when(~F.coalesce(F.isnan(number), F.lit(False)), compound)
    return made


def promote(df: DataFrame, fields: Iterable[str], payload: str = "payload") -> DataFrame:
    """Records with the columns of promoted fields."""
    return df.withColumns(columns(check_fields(fields), payload))


def frequent_fields(df: DataFrame, payload: str = "payload") -> DataFrame:
    """``field, records`` of the payload, most frequent first: what may be worth promoting."""
    names = F.explode(F.map_keys(F.col(payload).cast("map<string,variant>")))
    return df.select(names.alias("field")).groupBy("field").agg(F.count(F.lit(1)).alias("records")).orderBy(F.desc("records"), "field")
