"""Vector arithmetic as Column expressions; everything is computed in DOUBLE."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from semstore.errors import EmbeddingError, RecordError

METRICS = ("cosine", "dot", "euclidean")
#: Metrics where a smaller score is the better one.
ASCENDING = ("euclidean",)


def check_metric(metric: str) -> str:
    name = metric.lower() if isinstance(metric, str) else metric
    if name not in METRICS:
        raise RecordError(f"unknown metric {metric!r}, expected one of {', '.join(METRICS)}")
    return name


def as_vector(value: Sequence[float]) -> list[float]:
    """A query vector given by the caller, checked and turned into plain floats."""
    if isinstance(value, (str, bytes)) or not hasattr(value, "__len__") or len(value) == 0:
        raise RecordError("a query vector must be a non-empty list of numbers")
    numbers = [float(x) for x in value]
    if not all(math.isfinite(x) for x in numbers):
        raise RecordError("a query vector must hold finite numbers only")
    return numbers


def literal(vector: Sequence[float]) -> Column:
    return F.expr("array(" + ",".join(f"{float(x)!r}D" for x in vector) + ")")


def as_double(vector: Column) -> Column:
    return vector.cast("array<double>")


def _same_size(a: Column, b: Column, value: Column) -> Column:
    # zip_with pads the shorter side with NULL, so a mismatch has to be caught here.
    message = F.lit("vectors of different dimensions cannot be compared")
    return F.when(F.size(a) == F.size(b), value).otherwise(F.raise_error(message).cast("double"))


def _sum_of(a: Column, b: Column, term: Callable[[Column, Column], Column]) -> Column:
    # The elements are cast one by one: casting the array would build a second one for every use.
    terms = F.zip_with(a, b, lambda x, y: term(x.cast("double"), y.cast("double")))
    return F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x)


def dot(a: Column, b: Column) -> Column:
    return _same_size(a, b, _sum_of(a, b, lambda x, y: x * y))


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def euclidean(a: Column, b: Column) -> Column:
    return F.sqrt(_same_size(a, b, _sum_of(a, b, lambda x, y: (x - y) * (x - y))))


def cosine(a: Column, b: Column, norm_a: Column | None = None, norm_b: Column | None = None) -> Column:
    """Cosine similarity; 0 where either vector is zero. Known norms can be passed in."""
    scale = (norm(a) if norm_a is None else norm_a) * (norm(b) if norm_b is None else norm_b)
    # try_divide names the norms once; a condition on them would compute them twice.
    ratio = F.try_divide(_sum_of(a, b, lambda x, y: x * y), scale)
    return _same_size(a, b, F.coalesce(ratio, F.lit(0.0)))


def score(metric: str, a: Column, b: Column, norm_a: Column | None = None, norm_b: Column | None = None) -> Column:
    if metric == "cosine":
        return cosine(a, b, norm_a, norm_b)
    return dot(a, b) if metric == "dot" else euclidean(a, b)


def normalize(v: Column) -> Column:
    """Scale to unit length; a zero vector stays as it is."""
    v = as_double(v)
    # The norm goes through a one-element array so that it is computed once per vector.
    scaled = F.transform(F.array(norm(v)), lambda n: F.when(n > 0, F.transform(v, lambda x: x / n)).otherwise(v))
    return F.element_at(scaled, 1)


def has_bad_element(v: Column) -> Column:
    """True when an element is missing, NaN or infinite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.exists(as_double(v), lambda x: ~finite(x))


def py_norm(vector: Sequence[float]) -> float:
    return math.sqrt(math.fsum(x * x for x in vector))


def check_same_dim(expected: int, got: int) -> None:
    if expected != got:
        raise EmbeddingError(f"expected a vector of dimension {expected}, got {got}")
