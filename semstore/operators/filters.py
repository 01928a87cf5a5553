"""Payload filters: a fluent builder, and their translation to one boolean Column.

A filter is written as a plain dict or made with :class:`FilterBuilder`:

* leaves ``{"match": {"key", "value"}}``, ``{"range": {"key", "gt"|"gte"|"lt"|"lte"}}``,
  ``{"geo_bounding_box": {"key", "bounding_box": {"top_left", "bottom_right"}}}``,
  ``{"geo_radius": {"key", "center", "radius"}}``;
* groups ``{"must": [...]}``, ``{"should": [...]}``, ``{"must_not": [...]}``;
* shorthand ``{"field": value}``, ``{"field": [values]}``, ``{"field": {"gte": 1}}``.

Several keys in one dict are ANDed. Every leaf is true or false, never NULL: a record that lacks the key does
not match, so a negated filter keeps it. On typed columns the leaves are written as ``col IS NOT NULL AND
comparison``, which stays two-valued under NOT and still reaches the Parquet scan; a ``coalesce`` would not.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from numbers import Real
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from semstore.errors import FilterError
from semstore.functions import geo

GROUPS = ("must", "should", "must_not")
BOUNDS = ("gt", "gte", "lt", "lte")
LEAVES = ("match", "range", "geo_bounding_box", "geo_radius")


# --- builder ---------------------------------------------------------------------------------------------------


class FilterBuilder:
    """Collects conditions; the last of ``and_/or_/not_`` before ``build`` joins all of them.

    One condition alone is returned as it is, whatever the operator, and no condition gives None. The functions
    ``all_of``, ``any_of`` and ``none_of`` say the same without that pitfall.
    """

    def __init__(self) -> None:
        self._conditions: list[dict] = []
        self._joined_by = "must"

    def where(self, key: str) -> FieldCondition:
        return FieldCondition(self, key)

    def add(self, condition: Mapping) -> FilterBuilder:
        self._conditions.append(dict(condition))
        return self

    def _join_by(self, group: str) -> FilterBuilder:
        self._joined_by = group
        return self

    def and_(self) -> FilterBuilder:
        return self._join_by("must")

    def or_(self) -> FilterBuilder:
        return self._join_by("should")

    def not_(self) -> FilterBuilder:
        return self._join_by("must_not")

    def and_all(self, *builders: FilterBuilder) -> FilterBuilder:
        self._conditions += _built(builders)
        return self

    def or_any(self, *builders: FilterBuilder) -> FilterBuilder:
        parts = _built(builders)
        return self.add({"should": parts}) if parts else self

    def build(self) -> dict | None:
        if len(self._conditions) > 1:
            return {self._joined_by: list(self._conditions)}
        return self._conditions[0] if self._conditions else None

    def validate(self) -> None:
        if not self._conditions:
            raise FilterError("a filter needs at least one condition")
        for condition in self._conditions:
            check_filter(condition)


class FieldCondition:
    """The comparisons offered on one payload field; each returns the builder."""

    def __init__(self, builder: FilterBuilder, key: str) -> None:
        self._builder = builder
        self._key = key

    def _range(self, **bounds: float) -> FilterBuilder:
        return self._builder.add({"range": {"key": self._key, **bounds}})

    def equals(self, value: str | float | bool) -> FilterBuilder:
        return self._builder.add(equality(self._key, value))

    matches = equals
    contains = equals

    def not_equals(self, value: str | float | bool) -> FilterBuilder:
        return self._builder.add(none_of(equality(self._key, value)))

    def one_of(self, values: Sequence) -> FilterBuilder:
        return self._builder.add({self._key: list(values)})

    def greater_than(self, value: float) -> FilterBuilder:
        return self._range(gt=value)

    def greater_than_or_equal(self, value: float) -> FilterBuilder:
        return self._range(gte=value)

    def less_than(self, value: float) -> FilterBuilder:
        return self._range(lt=value)

    def less_than_or_equal(self, value: float) -> FilterBuilder:
        return self._range(lte=value)

    def in_range(self, low: float, high: float) -> FilterBuilder:
        if low > high:
            raise FilterError("the lower end of a range lies above the upper end", "range", self._key)
        return self._range(gte=low, lte=high)

    def in_bounding_box(self, top_left: Mapping, bottom_right: Mapping) -> FilterBuilder:
        box = {"top_left": dict(top_left), "bottom_right": dict(bottom_right)}
        return self._builder.add({"geo_bounding_box": {"key": self._key, "bounding_box": box}})

    def within_radius(self, center: Mapping, radius_m: float) -> FilterBuilder:
        if radius_m <= 0:
            raise FilterError("a radius must be positive", "geo_radius", self._key)
        return self._builder.add({"geo_radius": {"key": self._key, "center": dict(center), "radius": radius_m}})


def _built(builders: Sequence[FilterBuilder]) -> list[dict]:
    return [part for part in (builder.build() for builder in builders) if part]


def new_filter() -> FilterBuilder:
    return FilterBuilder()


def equality(key: str, value: str | float | bool) -> dict:
    return {"match": {"key": key, "value": value}}


def value_range(key: str, low: float | None = None, high: float | None = None) -> dict:
    """A range open on one side at most; low > high is allowed here and matches nothing."""
    bounds = {name: v for name, v in (("gte", low), ("lte", high)) if v is not None}
    if not bounds:
        raise FilterError("a range needs a lower or an upper end", "range", key)
    return {"range": {"key": key, **bounds}}


def _combine(group: str, filters: Sequence[Mapping]) -> dict:
    if not filters:
        raise FilterError("there are no filters to combine")
    return dict(filters[0]) if len(filters) == 1 else {group: [dict(f) for f in filters]}


def all_of(*filters: Mapping) -> dict:
    return _combine("must", filters)


def any_of(*filters: Mapping) -> dict:
    return _combine("should", filters)


def none_of(*filters: Mapping) -> dict:
    return {"must_not": [dict(f) for f in filters]}


def is_empty(flt: Mapping | None) -> bool:
    """True when a filter constrains nothing: no conditions, or empty groups only."""
    return not flt or not _conditions(flt)


# --- checks that run while the plan is built ---------------------------------------------------------------------


def _is_number(value: Any) -> bool:
    return isinstance(value, Real) and not isinstance(value, bool)


def _key_of(kind: str, body: Any) -> str:
    key = body.get("key") if isinstance(body, Mapping) else None
    if not isinstance(key, str) or not key:
        raise FilterError(f"a {kind} condition needs a key", kind)
    return key


def _checked_value(key: str, value: Any) -> str | float | bool:
    if isinstance(value, (str, bool)) or _is_number(value):
        return value
    raise FilterError("a value to match must be a string, a number or a boolean", "match", key)


def _checked_bounds(key: str, body: Mapping) -> dict[str, float]:
    bounds = {name: body[name] for name in BOUNDS if body.get(name) is not None}
    if not bounds:
        raise FilterError("a range needs at least one bound", "range", key)
    if not all(_is_number(v) and math.isfinite(v) for v in bounds.values()):
        raise FilterError("the bounds of a range must be finite numbers", "range", key)
    return bounds


def _checked_point(kind: str, key: str, point: Any) -> tuple[float, float]:
    if not isinstance(point, Mapping):
        raise FilterError("a geographic point needs lon and lat", kind, key)
    for name, limit in (("lat", 90), ("lon", 180)):
        value = point.get(name)
        if not _is_number(value) or not math.isfinite(value) or abs(value) > limit:
            raise FilterError(f"{name} must be a number between -{limit} and {limit}", kind, key)
    return float(point["lon"]), float(point["lat"])


def _conditions(flt: Mapping) -> list[tuple]:
    """The conditions of one dict, checked, as (kind, key or None, argument); they are ANDed."""
    if not isinstance(flt, Mapping):
        raise FilterError("a filter must be a dict")
    found: list[tuple] = []
    for name, body in flt.items():
        if name in GROUPS and isinstance(body, (list, tuple)):
            parts = [part for part in map(_conditions, body) if part]
            if parts:
                found.append((name, None, parts))
        elif name in LEAVES and isinstance(body, Mapping):
            found.append(_leaf(name, _key_of(name, body), body))
        elif not isinstance(name, str) or not name:
            raise FilterError("a field name must be a non-empty string")
        elif isinstance(body, Mapping):
            found.append(("range", name, _checked_bounds(name, body)))
        elif isinstance(body, (list, tuple, set, frozenset)):
            found.append(("one_of", name, [_checked_value(name, v) for v in body]))
        else:
            found.append(("match", name, _checked_value(name, body)))
    return found


def _leaf(kind: str, key: str, body: Mapping) -> tuple:
    if kind == "match":
        return kind, key, _checked_value(key, body.get("value"))
    if kind == "range":
        return kind, key, _checked_bounds(key, body)
    if kind == "geo_bounding_box":
        box = body.get("bounding_box")
        box = box if isinstance(box, Mapping) else {}
        corners = [_checked_point(kind, key, box.get(name)) for name in ("top_left", "bottom_right")]
        return kind, key, (*corners[0], *corners[1])
    radius = body.get("radius")
    if not _is_number(radius) or not math.isfinite(radius) or radius <= 0:
        raise FilterError("a radius must be a positive number", kind, key)
    return kind, key, (*_checked_point(kind, key, body.get("center")), float(radius))


def check_filter(flt: Mapping) -> None:
    """Raise when a filter or anything nested in it is malformed."""
    _conditions(flt)


# --- translation to a Column --------------------------------------------------------------------------------------


def predicate(df: DataFrame, flt: Mapping | None, payload: str | None = None) -> Column:
    """One two-valued Column for a filter.

    A key names a column of ``df``; failing that, a path in the VARIANT column ``payload`` (by default the column
    of that name, when there is one); failing that, nothing matches.
    """
    if is_empty(flt):
        return F.lit(True)
    types = {field.name: field.dataType for field in df.schema.fields}
    if payload is None and isinstance(types.get("payload"), T.VariantType):
        payload = "payload"
    return _all([_condition(types, payload, c) for c in _conditions(flt)])


def _all(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, columns) if columns else F.lit(True)


def _condition(types: Mapping, payload: str | None, condition: tuple) -> Column:
    kind, key, argument = condition
    if kind in GROUPS:
        parts = [_all([_condition(types, payload, c) for c in part]) for part in argument]
        if kind == "must":
            return _all(parts)
        either = reduce(lambda a, b: a | b, parts)
        return either if kind == "should" else ~either
    if key in types:
        field, data_type = F.col(f"`{key}`"), types[key]
        if isinstance(data_type, T.VariantType):
            return _variant_leaf(field, kind, argument)
        return _typed_leaf(field, data_type, kind, argument)
    if payload is not None:
        leaf = _variant_leaf(F.try_variant_get(F.col(payload), _path(key), "variant"), kind, argument)
        return _promoted_leaf(key, kind, argument, leaf) if promoted("rest", key) in types else leaf
    return F.lit(False)


def promoted(kind: str, key: str) -> str:
    """The column that holds the values of one kind of a promoted payload field."""
    return f"_{kind}_of_{key}"


def _promoted_leaf(key: str, kind: str, argument: Any, leaf: Column) -> Column:
    """A test on the columns of a promoted field, and on the payload (``leaf``) for rows that they leave open.

    Written as two conditions, of which the first is on columns only: it reaches the scan.
    """
    field = lambda family: F.col(f"`{promoted(family, key)}`")
    open_ = field("rest").isNull()
    if kind in ("match", "one_of"):
        typed = []
        for value in [argument] if kind == "match" else argument:
            family = _family_of_value(value)
            typed.append((family, F.lit(float(value) if family == "number" else value)))
        tests = []
        for family, column in (("string", "text"), ("number", "number"), ("boolean", "boolean")):
            values = [v for f, v in typed if f == family]
            if values:
                same = field(column) == values[0] if len(values) == 1 else field(column).isin(values)
                tests.append(field(column).isNotNull() & same)
        test = reduce(lambda a, b: a | b, tests) if tests else F.lit(False)
        open_ = open_ | field("rest")
    elif kind == "range":
        # a promoted number is never NaN, which the scan could not be asked about
        test = field("number").isNotNull() & _all([_compare(field("number"), name, bound) for name, bound in argument.items()])
    else:
        return leaf
    # as a second OR, the optimizer would merge the two, and nothing would reach the scan
    return (test | open_) & F.when(test, True).otherwise(leaf)


def _family(data_type: T.DataType) -> str | None:
    if isinstance(data_type, T.NumericType):
        return "number"
    return {T.StringType: "string", T.BooleanType: "boolean"}.get(type(data_type))


def _family_of_value(value: Any) -> str:
    if isinstance(value, bool):
        return "boolean"
    return "string" if isinstance(value, str) else "number"


def _fitting(values: Sequence, data_type: T.DataType) -> list:
    """The values a column of this type can equal, in the form the scan can compare without a cast."""
    kept = []
    for value in values:
        if _family_of_value(value) != _family(data_type):
            continue
        if isinstance(data_type, T.IntegralType):
            if value != value or math.isinf(value) or value != int(value):
                continue
            value = int(value)
        elif _family(data_type) == "number":
            value = float(value)
        kept.append(value)
    return kept


def _typed_leaf(field: Column, data_type: T.DataType, kind: str, argument: Any) -> Column:
    if kind in ("match", "one_of"):
        values = [argument] if kind == "match" else argument
        if isinstance(data_type, T.ArrayType):
            values = _fitting(values, data_type.elementType)
            hits = [F.array_contains(field, F.lit(v)) for v in values]
            return F.coalesce(*hits, F.lit(False)) if len(hits) == 1 else _any_hit(hits)
        values = _fitting(values, data_type)
        if not values:
            return F.lit(False)
        same = field == F.lit(values[0]) if len(values) == 1 else field.isin(values)
        return field.isNotNull() & same
    if kind == "range":
        if _family(data_type) != "number":
            return F.lit(False)
        bounds = argument.items()
        if isinstance(data_type, T.IntegralType):
            bounds = [(name, _whole_bound(name, bound)) for name, bound in bounds]
        number = _all([_compare(field, name, bound) for name, bound in bounds])
        if isinstance(data_type, (T.FloatType, T.DoubleType)):
            number = number & ~F.isnan(field)
        return field.isNotNull() & number
    names = {f.name for f in data_type.fields} if isinstance(data_type, T.StructType) else set()
    if not {"lon", "lat"} <= names:
        return F.lit(False)
    return _geo(field["lon"].cast("double"), field["lat"].cast("double"), kind, argument)


def _any_hit(hits: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, [F.coalesce(h, F.lit(False)) for h in hits]) if hits else F.lit(False)


def _whole_bound(name: str, bound: float) -> float:
    """The same bound for whole numbers, so that the scan compares without a cast."""
    whole = math.floor(bound) if name in ("gt", "lte") else math.ceil(bound)
    return whole if abs(whole) < 2**63 else float(bound)


def _compare(field: Column, name: str, bound: float) -> Column:
    bound = F.lit(bound)
    if name == "gt":
        return field > bound
    if name == "gte":
        return field >= bound
    return field < bound if name == "lt" else field <= bound


def _geo(lon: Column, lat: Column, kind: str, argument: tuple) -> Column:
    test = geo.in_box if kind == "geo_bounding_box" else geo.within_radius
    return lon.isNotNull() & lat.isNotNull() & test(lon, lat, *argument)


# Payload values are compared strictly: the text "1" is not the number 1, so the kind is looked at first.
_NUMBER_KINDS = "^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL)"


def _path(key: str) -> str:
    if "'" in key and '"' in key:
        raise FilterError("a payload key cannot hold both kinds of quotes", key=key)
    return f'$["{key}"]' if "'" in key else f"$['{key}']"


def _variant_number(value: Column) -> Column:
    is_number = F.schema_of_variant(value).rlike(_NUMBER_KINDS)
    return F.when(is_number, F.try_variant_get(value, "$", "double"))


def _variant_in(value: Column, wanted: Sequence[Any]) -> Column:
    """Whether a value equals one of those wanted: one test per family of types, however many there are."""
    families: dict[str, list] = {}
    for one in wanted:
        families.setdefault(_family_of_value(one), []).append(one)
    hits = []
    for family, values in families.items():
        if family == "number":
            hits.append(_variant_number(value).isin([float(v) for v in values]))
            continue
        kind, spark_type = ("STRING", "string") if family == "string" else ("BOOLEAN", "boolean")
        hits.append((F.schema_of_variant(value) == kind) & F.try_variant_get(value, "$", spark_type).isin(values))
    return _any_hit(hits)


def _variant_leaf(value: Column, kind: str, argument: Any) -> Column:
    if kind in ("match", "one_of"):
        values = [argument] if kind == "match" else argument
        elements = F.when(
            F.schema_of_variant(value).startswith("ARRAY<"), F.try_variant_get(value, "$", "array<variant>")
        )
        return _any_hit([_variant_in(value, values), F.exists(elements, lambda e: _variant_in(e, values))])
    if kind == "range":
        number = _variant_number(value)
        return F.coalesce(_all([_compare(number, name, bound) for name, bound in argument.items()]), F.lit(False))
    lon, lat = (_variant_number(F.try_variant_get(value, f"$.{name}", "variant")) for name in ("lon", "lat"))
    return F.coalesce(_geo(lon, lat, kind, argument), F.lit(False))
