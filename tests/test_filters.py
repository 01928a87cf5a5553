"""Filters: what the builder writes, what is refused, and which records match, against a plain evaluation."""

import json
import math
import operator

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from semstore.errors import FilterError
from semstore.operators import filters
from semstore.operators.filters import check_filter, is_empty, new_filter, predicate

A, B = filters.equality("a", 1), filters.equality("b", "x")


def test_builder_leaves():
    for name in ("equals", "matches", "contains"):
        made = getattr(new_filter().where("a"), name)("t").build()
        assert made == {"match": {"key": "a", "value": "t"}}
    assert new_filter().where("p").greater_than(1).build() == {"range": {"key": "p", "gt": 1}}
    assert new_filter().where("p").less_than_or_equal(2).build() == {"range": {"key": "p", "lte": 2}}
    assert new_filter().where("p").in_range(1, 2).build() == {"range": {"key": "p", "gte": 1, "lte": 2}}
    assert new_filter().where("p").not_equals("x").build() == {"must_not": [{"match": {"key": "p", "value": "x"}}]}


def test_builder_joins_all_by_the_last_operator():
    built = new_filter().add(A).and_().add(B).and_().or_().build()
    assert built == {"should": [A, B]}
    assert new_filter().add(A).add(B).not_().build() == {"must_not": [A, B]}
    assert new_filter().add(A).add(B).build() == {"must": [A, B]}


def test_builder_single_condition_is_bare():
    assert new_filter().not_().add(A).build() == A
    assert new_filter().build() is None


def test_builder_nesting():
    assert new_filter().and_all(new_filter().add(A), new_filter(), new_filter().add(B)).build() == {"must": [A, B]}
    assert new_filter().or_any(new_filter().add(A), new_filter().add(B)).build() == {"should": [A, B]}
    assert new_filter().or_any(new_filter()).build() is None


def test_builder_validate():
    with pytest.raises(FilterError):
        new_filter().validate()
    with pytest.raises(FilterError):
        new_filter().where("").equals(1).validate()
    new_filter().where("a").equals(1).validate()


def test_helpers():
    assert filters.all_of(A) == A and filters.any_of(A, B) == {"should": [A, B]}
    assert filters.none_of(A) == {"must_not": [A]}
    assert filters.value_range("p", 3, 1) == {"range": {"key": "p", "gte": 3, "lte": 1}}
    for bad in (lambda: filters.all_of(), lambda: filters.any_of(), lambda: filters.value_range("p")):
        with pytest.raises(FilterError):
            bad()


def test_builder_refuses_at_once():
    with pytest.raises(FilterError):
        new_filter().where("p").in_range(2, 1)
    with pytest.raises(FilterError):
        new_filter().where("g").within_radius({"lon": 0, "lat": 0}, 0)


@pytest.mark.parametrize(
    "bad",
    [
        {"match": {"key": "", "value": 1}},
        {"match": {"key": 3, "value": 1}},
        {"match": {"key": "a", "value": None}},
        {"match": {"key": "a", "value": [1]}},
        {"range": {"key": "a"}},
        {"range": {"key": "a", "gte": "2024-01-10T00:00:00Z"}},
        {"range": {"key": "a", "gt": math.inf}},
        {"range": {"key": "a", "gt": True}},
        {"geo_bounding_box": {"key": "g", "bounding_box": {"top_left": {"lon": 0, "lat": 91}}}},
        {"geo_bounding_box": {"key": "g"}},
        {"geo_radius": {"key": "g", "center": {"lon": 181, "lat": 0}, "radius": 5}},
        {"geo_radius": {"key": "g", "center": {"lon": 1, "lat": 0}, "radius": -5}},
        {"geo_radius": {"key": "g", "center": {"lon": 1, "lat": 0}, "radius": math.nan}},
        {"must": [{"should": [{"match": {"key": "", "value": 1}}]}]},
        {"a": None},
        {"a": {"near": 1}},
        {"": 1},
        "text",
    ],
)
def test_malformed_filters_are_refused(bad):
    with pytest.raises(FilterError):
        check_filter(bad)


def test_empty_filters():
    for flt in (None, {}, {"must": []}, {"should": []}, {"must_not": [{}]}, {"must": [{"should": []}]}):
        assert is_empty(flt)
    assert not is_empty({"should": [], "a": 1})


# The sample payloads a filter is tried on, by name.
PAYLOADS = {
    "basicDocument": {"type": "document"},
    "newsArticle": {
        "type": "news", "category": "technology", "sentiment": 0.8, "tags": ["AI", "research"],
        "publishedAt": "2024-01-10T09:00:00Z",
    },
    "researchPaper": {"type": "research", "category": "computer-science", "year": 2024, "citations": 42},
    "email": {"type": "email", "priority": "normal", "hasAttachments": False},
    "socialPost": {"type": "social", "likes": 156, "isReply": False},
    "product": {"type": "product", "category": "software", "price": 299.99, "inStock": True, "tags": ["vector", "AI"]},
    "supportTicket": {"type": "support", "priority": "high", "category": "technical", "tags": ["API"]},
    "userContent": {"type": "blog", "category": "technology", "tags": ["databases"], "isPublic": True},
}
COLUMNS = (
    "name string, type string, category string, sentiment double, tags array<string>, publishedAt string, year int, "
    "citations bigint, priority string, hasAttachments boolean, likes int, isReply boolean, price double, "
    "inStock boolean, isPublic boolean"
)


@pytest.fixture(scope="module")
def typed(spark):
    names = [c.strip().split(" ")[0] for c in COLUMNS.split(",")]
    rows = [tuple({"name": k, **p}.get(c) for c in names) for k, p in PAYLOADS.items()]
    return spark.createDataFrame(rows, COLUMNS).cache()


@pytest.fixture(scope="module")
def untyped(spark):
    rows = [(k, json.dumps(p)) for k, p in PAYLOADS.items()]
    return spark.createDataFrame(rows, "name string, json string").select(
        "name", F.parse_json("json").alias("payload")
    ).cache()


CASES = [
    ({"match": {"key": "type", "value": "news"}}, {"newsArticle"}),
    ({"match": {"key": "category", "value": "technology"}}, {"newsArticle", "userContent"}),
    ({"range": {"key": "sentiment", "gte": 0.7, "lte": 1.0}}, {"newsArticle"}),
    ({"match": {"key": "tags", "value": "AI"}}, {"newsArticle", "product"}),
    ({"must": [{"match": {"key": "type", "value": "news"}}, {"range": {"key": "sentiment", "gte": 0.5}}]}, {"newsArticle"}),
    ({"should": [{"type": "email"}, {"type": "social"}]}, {"email", "socialPost"}),
    ({"must_not": [{"type": "news"}]}, set(PAYLOADS) - {"newsArticle"}),
    ({"must_not": [{"priority": "high"}, {"inStock": True}]}, set(PAYLOADS) - {"supportTicket", "product"}),
    ({"isReply": False}, {"socialPost"}),
    ({"isReply": 0}, set()),
    ({"likes": "156"}, set()),
    ({"likes": 156.0, "type": ["social", "news"]}, {"socialPost"}),
    ({"tags": ["API", "databases"]}, {"supportTicket", "userContent"}),
    ({"category": {"gte": 1}}, set()),
    ({"nowhere": 1}, set()),
    ({"must_not": [{"nowhere": 1}]}, set(PAYLOADS)),
    ({}, set(PAYLOADS)),
]


@pytest.mark.parametrize("flt, expected", CASES)
@pytest.mark.parametrize("form", ["typed", "untyped"])
def test_sample_filters(request, flt, expected, form):
    df = request.getfixturevalue(form)
    assert {r["name"] for r in df.where(predicate(df, flt)).select("name").collect()} == expected


# --- against a plain evaluation ------------------------------------------------------------------------------------

RECORDS = [
    {"n": n, "d": d, "s": s, "b": b, "t": t}
    for i, (n, d, s, b, t) in enumerate(
        [
            (1, 0.5, "x", True, ["x", "y"]),
            (2, 1.0, "y", False, []),
            (None, None, None, None, None),
            (3, 2.5, "1", True, ["1"]),
            (0, -1.0, "", None, ["z", None]),
            (2, None, "x", False, ["y"]),
        ]
    )
]


def plain(record, flt):
    """A record matches when all keys of the filter do; a missing key never matches."""
    kind = lambda v: "b" if isinstance(v, bool) else "s" if isinstance(v, str) else "n"

    def equal(value, wanted):
        if isinstance(value, list):
            return any(equal(v, wanted) for v in value)
        return value is not None and kind(value) == kind(wanted) and value == wanted

    def within(value, bounds):
        if value is None or isinstance(value, list) or kind(value) != "n":
            return False
        tests = {"gt": operator.gt, "gte": operator.ge, "lt": operator.lt, "lte": operator.le}
        return all(tests[k](value, b) for k, b in bounds.items())

    results = []
    for name, body in flt.items():
        if name in filters.GROUPS:
            parts = [plain(record, p) for p in body]
            if parts:
                results.append(
                    all(parts) if name == "must" else any(parts) if name == "should" else not any(parts)
                )
        elif name == "match":
            results.append(equal(record.get(body["key"]), body["value"]))
        elif name == "range":
            results.append(within(record.get(body["key"]), {k: v for k, v in body.items() if k != "key"}))
    return all(results)


keys = st.sampled_from(["n", "d", "s", "b", "t", "gone"])
values = st.sampled_from([0, 1, 2, 2.5, 1.5, "x", "1", "", True, False, "z"])
leaves = st.one_of(
    st.builds(lambda k, v: {"match": {"key": k, "value": v}}, keys, values),
    st.builds(
        lambda k, b: {"range": {"key": k, **b}},
        keys,
        st.dictionaries(st.sampled_from(filters.BOUNDS), st.sampled_from([-1, 0.5, 1, 1.5, 2, 2.5]), min_size=1),
    ),
)
trees = st.recursive(
    leaves,
    lambda inner: st.builds(
        lambda g, parts: {g: parts}, st.sampled_from(filters.GROUPS), st.lists(inner, min_size=1, max_size=3)
    ),
    max_leaves=6,
)


@given(st.lists(trees, min_size=12, max_size=12))
@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
def test_random_filters_on_both_forms(spark, many):
    """Dozens of random filters, on typed columns and on a VARIANT, in one job each."""
    typed = spark.createDataFrame(
        [(i, r["n"], r["d"], r["s"], r["b"], r["t"]) for i, r in enumerate(RECORDS)],
        "i int, n int, d double, s string, b boolean, t array<string>",
    )
    rows = [(i, json.dumps({k: v for k, v in r.items() if v is not None})) for i, r in enumerate(RECORDS)]
    untyped = spark.createDataFrame(rows, "i int, json string").select("i", F.parse_json("json").alias("payload"))
    for df in (typed, untyped):
        found = df.select("i", *[predicate(df, f).alias(f"f{j}") for j, f in enumerate(many)]).collect()
        for row in found:
            for j, flt in enumerate(many):
                assert row[f"f{j}"] is plain(RECORDS[row["i"]], flt), (flt, RECORDS[row["i"]])


def test_geo(spark):
    df = spark.createDataFrame(
        [("paris", 2.35, 48.86), ("london", -0.13, 51.51), ("fiji", 179.0, -17.7), ("samoa", -171.8, -13.8), ("none", None, None)],
        "name string, lon double, lat double",
    ).select("name", F.struct("lon", "lat").alias("at"))
    names = lambda flt: {r[0] for r in df.where(predicate(df, flt)).select("name").collect()}
    near = lambda lon, lat, r: new_filter().where("at").within_radius({"lon": lon, "lat": lat}, r).build()
    assert names(near(2.35, 48.86, 1_000)) == {"paris"}
    assert names(near(2.35, 48.86, 350_000)) == {"paris", "london"}
    assert names(near(-175.0, -15.0, 900_000)) == {"fiji", "samoa"}
    assert names(near(0.0, 90.0, 4_700_000)) == {"paris", "london"}
    assert names(near(0.0, 0.0, 21_000_000)) == {"paris", "london", "fiji", "samoa"}
    box = new_filter().where("at").in_bounding_box({"lon": 170, "lat": 0}, {"lon": -170, "lat": -30}).build()
    assert names(box) == {"fiji", "samoa"}
    assert "none" in names(filters.none_of(box))
