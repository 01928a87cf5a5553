import math

import pytest
from pyspark.sql import functions as F

from semstore.errors import RecordError
from semstore.functions import vectors


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def vec(*xs):
    return vectors.literal(xs)


def test_cosine_of_units(spark):
    assert one(spark, vectors.cosine(vec(1, 0, 0), vec(1, 0, 0))) == 1.0
    assert one(spark, vectors.cosine(vec(1, 0, 0), vec(0, 1, 0))) == 0.0
    assert one(spark, vectors.cosine(vec(1, 0, 0), vec(-2, 0, 0))) == -1.0


def test_cosine_of_a_zero_vector_is_zero(spark):
    assert one(spark, vectors.cosine(vec(0, 0, 0), vec(1, 2, 3))) == 0.0


def test_dot_and_euclidean(spark):
    assert one(spark, vectors.dot(vec(1, 2, 3), vec(4, 5, 6))) == 32.0
    assert one(spark, vectors.euclidean(vec(0, 0), vec(3, 4))) == 5.0


@pytest.mark.parametrize("measure", [vectors.dot, vectors.cosine, vectors.euclidean])
def test_unequal_dimensions_are_an_error(spark, measure):
    with pytest.raises(Exception, match="different dimensions"):
        one(spark, measure(vec(1, 2), vec(1, 2, 3)))
    with pytest.raises(Exception, match="different dimensions"):
        one(spark, measure(vec(0, 0), vec(1, 2, 3)))


def test_normalize(spark):
    made = one(spark, vectors.normalize(vec(3, 4)))
    assert made == pytest.approx([0.6, 0.8])
    assert one(spark, vectors.normalize(vec(0, 0))) == [0.0, 0.0]


def test_floats_are_computed_as_doubles(spark):
    value = one(spark, vectors.dot(vec(0.1).cast("array<float>"), vec(3.0)))
    assert value != 0.1 * 3 and math.isclose(value, 0.3, rel_tol=1e-6)


def test_bad_elements(spark):
    rows = [([1.0, 2.0],), ([1.0, None],), ([float("nan")],), ([float("inf")],), ([],)]
    df = spark.createDataFrame(rows, "v array<double>")
    assert [r[0] for r in df.select(vectors.has_bad_element(F.col("v"))).collect()] == [False, True, True, True, False]


@pytest.mark.parametrize("bad", [[], "abc", [float("nan")], [1.0, float("inf")], None])
def test_query_vectors_are_checked(bad):
    with pytest.raises(RecordError):
        vectors.as_vector(bad)


def test_metric_names():
    assert vectors.check_metric("Cosine") == "cosine"
    with pytest.raises(RecordError):
        vectors.check_metric("manhattan")
