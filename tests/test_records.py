import pytest
from pyspark.sql import functions as F

from semstore.errors import RecordError
from semstore.operators import counts, quality, records
from semstore.plans import arguments, sizing


@pytest.fixture(scope="module")
def coll(spark):
    rows = [(f"k{i:02d}", [float(i)], "ab"[i % 2], i) for i in range(20)]
    return spark.createDataFrame(rows, "id string, vector array<double>, kind string, n int")


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


def test_latest_of_a_hot_id(spark):
    rows = [("hot", i) for i in range(500)] + [(f"cold{i}", i) for i in range(20)]
    df = spark.createDataFrame(rows, "id string, seq int").repartition(8)
    got = {r["id"]: r["seq"] for r in records.latest(df, [F.col("seq").desc()]).collect()}
    assert got == {"hot": 499, **{f"cold{i}": i for i in range(20)}}


def test_upsert_replaces_whole_records(spark, coll):
    batch = spark.createDataFrame([("k01", [9.0]), ("new", [8.0])], "id string, vector array<double>")
    made = records.upsert(coll, batch)
    assert made.count() == 21
    assert made.where("id = 'k01'").first().asDict() == {"id": "k01", "vector": [9.0], "kind": None, "n": None}


@pytest.mark.parametrize("limit", [1_000, 1])
def test_ids_as_list_and_table(spark, coll, monkeypatch, limit):
    monkeypatch.setattr(sizing, "LITERAL_IDS", limit)
    table = spark.createDataFrame([("k03",), ("k03",), ("zz",)], "x string")
    assert ids(records.get_by_ids(coll, [" k03", "k05 ", "zz"])) == ["k03", "k05"]
    assert ids(records.get_by_ids(coll, table)) == ["k03"]
    assert ids(records.delete_by_ids(coll, ["k03", "zz"])) == ids(coll.where("id != 'k03'"))
    assert ids(records.delete_by_ids(coll, table)) == ids(coll.where("id != 'k03'"))


def test_get_shape(coll):
    found = records.get_by_ids(coll, ["k03"], with_payload=False)
    assert found.columns == ["id", "score"] and found.first()["score"] == 0.0
    assert records.get_by_ids(coll, ["k03"], with_vector=True).columns == ["id", "score", "kind", "n", "vector"]
    for call in (records.get_by_ids, records.delete_by_ids):
        with pytest.raises(RecordError):
            call(coll, [])


def test_flags(spark, coll):
    batch = spark.createDataFrame([("k01",), ("zz",), ("k01",)], "id string")
    got = sorted((r["id"], r["was_update"]) for r in records.existing_flags(batch, coll).collect())
    assert got == [("k01", True), ("k01", True), ("zz", False)]
    assert not any(r["was_update"] for r in records.existing_flags(batch, None).collect())


def test_delete_and_update_by_filter(coll):
    assert ids(records.delete_by_filter(coll, {"kind": "a"})) == ids(coll.where("kind = 'b'"))
    made = records.update_payload(coll, {"n": {"gte": 18}}, {"kind": "c", "extra": 1.5})
    got = {r["id"]: (r["kind"], r["extra"]) for r in made.collect()}
    assert got["k19"] == ("c", 1.5) and got["k01"] == ("b", None)
    for empty in (None, {}, {"must": []}, {"must_not": [{}]}):
        with pytest.raises(RecordError):
            records.delete_by_filter(coll, empty)
        with pytest.raises(RecordError):
            records.update_payload(coll, empty, {"kind": "c"})
    with pytest.raises(RecordError):
        records.update_payload(coll, {"n": 1}, {})


def test_scroll_visits_every_record_once(coll):
    seen, offset = [], None
    while page := [r["id"] for r in records.scroll(coll, where={"kind": "a"}, limit=3, offset=offset).collect()]:
        seen += page
        offset = page[-1]
    assert seen == ids(coll.where("kind = 'a'"))


def test_counts(coll):
    assert counts.count_records(coll).first()["count"] == 20
    assert counts.count_records(coll, {"kind": "a"}).first()["count"] == 10
    assert abs(counts.count_records(coll, exact=False).first()["count"] - 20) <= 1
    row = counts.count_memory(coll, {"kind": "a"}, exact=True).first()
    assert row.asDict() == {"count": 10, "collection": "default", "has_filter": True, "exact": True}
    assert counts.count_memory(coll).first()["has_filter"] is False
    for bad in ({"where": [1]}, {"exact": "yes"}, {"collection": " "}):
        with pytest.raises(RecordError):
            counts.count_memory(coll, **bad)


def test_record_rules(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (" ", [1.0, 2.0], "id_blank"), (None, [1.0, 2.0], "id_blank"), (" ", [1.0, 2.0], "id_blank"),
        ("a", [], "vector_empty"), ("a", None, "vector_empty"), ("a", [1.0, nan], "vector_not_finite"),
        ("a", [inf, 1.0], "vector_not_finite"), ("a", [1.0, None], "vector_not_finite"),
        ("a", [1.0], "dimension_mismatch"), ("a", [1.0, 2.0], None),
    ]
    df = spark.createDataFrame(rows, "id string, vector array<double>, expected string")
    for row in df.withColumn("got", quality.record_reason(dim=2)).collect():
        assert row["got"] == row["expected"], row
    valid, rejects = quality.split_valid(df, quality.record_reason(dim=2))
    assert (valid.count(), rejects.count()) == (1, 9)
    with pytest.raises(RecordError):
        quality.require_valid(rejects)
    quality.require_valid(rejects.limit(0))
    assert df.where("id = 'a'").select(quality.record_reason(check_elements=False)).where("1=1").distinct().count() == 2


def test_store_rules(spark):
    rows = [
        ("i" * 512, "t", "p", None), ("i" * 513, "t", "p", "id_too_long"), ("", "t", "p", "id_blank"),
        ("i", " ", "p", "text_blank"), ("i", None, "p", "text_blank"), ("i", "t" * 1_000_001, "p", "text_too_long"),
        ("i", "t" * 100_001, "p", None), ("i", "t", "p" * 99_990, "payload_too_large"), ("i", "t", "p" * 99_980, None),
        ("\U0001f600" * 257, "t", "p", "id_too_long"),
    ]
    df = spark.createDataFrame(rows, "id string, text string, p string, expected string")
    given = F.struct(F.col("p").alias("payload"))
    limits = {"max_id": quality.MAX_ID_LENGTH, "max_text": quality.MAX_STORE_LENGTH, "max_payload": quality.MAX_PAYLOAD_LENGTH}
    reason = quality.store_reason(F.col("id"), F.col("text"), given, **limits)
    free = quality.store_reason(F.col("id"), F.col("text"), given)
    assert df.where(free.isin("id_too_long", "text_too_long", "payload_too_large")).count() == 0
    for row in df.select("expected", reason.alias("got")).collect():
        assert row["got"] == row["expected"]


def test_arguments():
    assert arguments.top_k(None) == arguments.top_k(0) == 10 and arguments.top_k(3) == 3
    assert arguments.tool_top_k(None) == 5 and arguments.tool_top_k(1000) == 1000
    assert arguments.query_text(" a ") == "a" and arguments.record_id(" a ") == "a"
    assert arguments.record_ids([" a", "a", 3]) == ["a", "3"]
    assert arguments.collection_name(None) == "default"
    for bad in (lambda: arguments.record_id("i" * 513, 512), lambda: arguments.record_id(3), lambda: arguments.top_k(True)):
        with pytest.raises(RecordError):
            bad()
