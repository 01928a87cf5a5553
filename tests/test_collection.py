"""Collections from end to end: storing, searching, changing, rewriting, and streaming into one."""

import uuid

import pytest
from pyspark.sql import functions as F

from semstore import Collection, RecordError
from semstore.errors import EmbeddingError
from semstore.operators.embed import PythonProvider
from semstore.plans import sizing, workspace
from semstore.streaming import ingest
from stand_ins import WaveProvider

WAVE = WaveProvider(32)


@pytest.fixture
def new(spark):
    made = []

    def create(dim=32, distance="Cosine", **options):
        made.append(f"c_{uuid.uuid4().hex}")
        return Collection.create(spark, made[-1], dim, distance, **options)

    yield create
    for name in made:
        if Collection.exists(spark, name):
            Collection.drop(spark, name)


def texts(spark, rows, columns):
    return spark.createDataFrame(rows, f"id string, text string, {columns}")


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_lifecycle(spark, new):
    coll = new()
    assert Collection.exists(spark, coll.name) and not Collection.exists(spark, "nobody")
    with pytest.raises(RecordError):
        Collection.create(spark, coll.name, 32)
    row = coll.describe().first()
    assert (row["status"], row["dim"], row["metric"], row["records"]) == ("green", 32, "cosine", 0)
    Collection.drop(spark, coll.name)
    with pytest.raises(RecordError):
        Collection.drop(spark, coll.name)
    with pytest.raises(RecordError):
        Collection(spark, coll.name)
    for bad in (("", 3), (None, 3), ("x", 0), ("x", -1), ("x", 2.5)):
        with pytest.raises(RecordError):
            Collection.create(spark, *bad)
    with pytest.raises(RecordError):
        Collection.create(spark, "x", 3, "Manhattan")


def test_store_search_delete(spark, new):
    coll = new(payload="category string, type string")
    rows = [
        ("doc:1", "Machine learning algorithms for prediction", "ai", "research", 0.8),
        (" doc:2 ", "Deep learning neural networks implementation", "ai", "implementation", 0.7),
        ("doc:3", "Web development best practices guide", "web", "guide", 0.6),
    ]
    docs = texts(spark, rows, "category string, type string, sentiment double")
    report, rejects = coll.store_memories(docs, WAVE, payload=["category", "type", "sentiment"])
    assert rejects.count() == 0
    first = {r["id"]: r for r in report.collect()}["doc:1"]
    assert (first["vector_dimensions"], first["was_update"], first["text_length"]) == (32, False, 42)
    assert first["payload_keys"] == ["category", "type", "sentiment", "text", "_stored_at", "_text_length", "_word_count", "_analysis"]

    found = coll.search_text("artificial intelligence machine learning", WAVE, 2, where={"category": "ai"}).collect()
    assert len(found) == 2 and {r["category"] for r in found} == {"ai"}
    assert ids(coll.get(["doc:1", "doc:3"])) == ["doc:1", "doc:3"]
    assert coll.count() == 3 and coll.count({"match": {"key": "category", "value": "ai"}}) == 2
    # Undeclared fields went to the VARIANT payload.
    assert coll.count({"sentiment": {"gte": 0.7}}) == 2 and coll.count({"_word_count": 5}) == 3
    assert [r.asDict() for r in coll.delete([" doc:2", "nobody"]).orderBy("id").collect()] == [
        {"id": "doc:2", "found": True}, {"id": "nobody", "found": False}
    ]
    assert coll.count() == 2 and "doc:2" not in ids(coll.search_text("deep learning neural networks", WAVE))
    assert coll.delete_memory("doc:2").first()["found"] is False
    again, _ = coll.store_memories(docs, WAVE, payload=["category", "type"])
    assert {r["id"]: r["was_update"] for r in again.collect()} == {"doc:1": True, "doc:2": False, "doc:3": True}


def test_batches_and_isolation(spark, new):
    one, other = new(), new()
    rows = [(f"batch:{i}", f"{w} document content", i) for i, w in enumerate(["First", "Second", "Third", "Fourth", "Fifth"])]
    docs = texts(spark, rows, "priority int")
    assert one.store_texts(docs, WAVE, payload=["priority"]).count() == 0
    assert one.count() == 5 and other.count() == 0
    found = one.search_text("document content", WAVE, 3).collect()
    assert len(found) == 3 and all(r["score"] > 0 for r in found)
    assert one.count({"priority": 1}) == 1


def test_fifty_records_in_five_categories(spark, new):
    names = ["tech", "science", "business", "health", "education"]
    rows = [(f"large:{i}", f"Document {i} about {names[i % 5]} topics and related content", names[i % 5]) for i in range(50)]
    coll = new(payload="category string")
    coll.store_texts(texts(spark, rows, "category string"), WAVE, payload=["category"])
    assert coll.count() == 50
    for name in names:
        found = coll.search_text(f"{name} topics", WAVE, 5, where={"category": name}).collect()
        assert len(found) == 5 and {r["category"] for r in found} == {name}
    assert coll.search_text("content topics", WAVE, 15).count() == 15


def test_bad_records_keep_the_batch_out(spark, new):
    coll = new(2)
    bad = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [1.0, float("nan")])], "id string, vector array<double>")
    with pytest.raises(RecordError, match="'b'"):
        coll.upsert(bad)
    assert coll.count() == 0
    rejects = coll.upsert(bad, strict=False).collect()
    assert [(r["id"], r["reject_reason"]) for r in rejects] == [("b", "vector_not_finite")]
    assert coll.count() == 1
    with pytest.raises(RecordError):
        coll.upsert(bad.limit(0))
    mixed = spark.createDataFrame([("c", [1.0]), ("d", [1.0, 2.0, 3.0])], "id string, vector array<double>")
    with pytest.raises(RecordError, match="dimension_mismatch"):
        coll.upsert(mixed)
    with pytest.raises(EmbeddingError):
        coll.search([1.0, 2.0, 3.0])


def test_last_write_wins(spark, new):
    coll = new(1, payload="n int, note string")
    rows = [("a", [1.0], 1, "x"), ("a", [2.0], 3, None), ("a", [3.0], 2, "y"), ("b", [1.0], 1, "z")]
    coll.upsert(spark.createDataFrame(rows, "id string, vector array<double>, n int, note string"), order_by=[F.col("n")])
    assert {r["id"]: (r["n"], r["note"]) for r in coll.read().collect()} == {"a": (3, None), "b": (1, "z")}
    coll.upsert(spark.createDataFrame([("a ", [5.0])], "id string, vector array<double>"))
    assert {r["id"]: r["n"] for r in coll.read().collect()} == {"a": None, "b": 1}


@pytest.mark.parametrize("limit", [sizing.RESULT_BROADCAST_BYTES, 0])
def test_changes_then_compaction(spark, new, monkeypatch, limit):
    monkeypatch.setattr(sizing, "RESULT_BROADCAST_BYTES", limit)
    coll = new(2, "Dot", payload="n int, tag string")
    rows = [(f"k{i}", [float(i), 1.0], i, "old") for i in range(20)]
    schema = "id string, vector array<double>, n int, tag string"
    coll.upsert(spark.createDataFrame(rows, schema))
    coll.compact()
    coll.delete_where({"n": {"gte": 15}})
    coll.update_where({"n": {"lt": 3}}, {"tag": "small"})
    coll.upsert(spark.createDataFrame([("k16", [100.0, 0.0], 16, "back")], schema))

    def state():
        return {r["id"]: (r["n"], r["tag"]) for r in coll.read().collect()}

    expected = {f"k{i}": (i, "small" if i < 3 else "old") for i in range(15)} | {"k16": (16, "back")}
    assert state() == expected
    assert [r["id"] for r in coll.search([1.0, 0.0], 2).collect()] == ["k16", "k14"]
    assert coll.count(exact=False) == 16 and coll.count_memory().first()["collection"] == coll.name
    coll.compact()
    assert state() == expected and Collection(spark, coll.name).count() == 16
    assert [r["id"] for r in coll.scroll(limit=2, offset="k1").collect()] == ["k10", "k11"]
    with pytest.raises(RecordError):
        coll.delete_where({})
    for wrong in ({}, {"id": "x"}, {"vector": [1.0]}, {"_norm": 1.0}, {" ": 1}):
        with pytest.raises(RecordError):
            coll.update_where({"n": 1}, wrong)


def test_many_changes_are_folded(spark, new):
    coll = new(1, compact_after=3)
    base = coll._base_path()
    for i in range(7):
        coll.upsert(spark.createDataFrame([(f"k{i % 5}", [float(i + 1)])], "id string, vector array<double>"))
    assert coll.count() == 5 and len(coll._change_names()) <= 2 and coll._base_path() == base
    assert {r["id"]: r["vector"] for r in coll.read().collect()}["k1"] == [7.0]


def test_files_are_removed(spark, new, tmp_path):
    coll = new(1, root=str(tmp_path / "own"), compact_after=3)
    for i in range(4):
        coll.upsert(spark.createDataFrame([(f"k{i}", [1.0])], "id string, vector array<double>"))
    coll.compact()
    assert len([f for f in (tmp_path / "own").iterdir() if f.name != "_commits"]) == 1 and coll.count() == 4
    Collection.drop(spark, coll.name)
    assert not list((tmp_path / "own").iterdir())


def test_the_latest_version_in_a_batch_wins(spark, new):
    coll = new(payload="n int")
    docs = texts(spark, [("a", "old text", 1), ("a", "new text", 3), ("a", "middle", 2), ("b", "one", 1)], "n int")
    for store in (coll.store_texts, coll.store_memories):
        with pytest.raises(RecordError, match="more than once"):
            store(docs, WAVE, payload=["n"])
        store(docs, WAVE, payload=["n"], order_by=[F.col("n")])
        assert {r["id"]: r["n"] for r in coll.read().collect()} == {"a": 3, "b": 1}


def test_each_text_is_embedded_once(spark, new):
    calls = spark.sparkContext.accumulator(0)

    def load():
        def model(batch):
            calls.add(len(batch))
            return [[1.0, 2.0] for _ in batch]

        return model

    coll = new(2)
    coll.store_memories(texts(spark, [(f"k{i}", "text", 1) for i in range(50)], "n int"), PythonProvider(load))
    assert calls.value == 50


def test_a_very_long_text_is_stored_and_found(spark, new):
    coll = new()
    long = "word " * 400_000 + "end"
    report, rejects = coll.store_memories(texts(spark, [("a", long, 1), ("b", "short", 2)], "n int"), WAVE)
    assert rejects.count() == 0 and {r["text_length"] for r in report.collect()} == {len(long), 5}
    assert coll.search_text(long, WAVE, 1).first()["id"] == "a"


@pytest.mark.parametrize("folder", [True, False])
def test_stream_of_a_table(spark, new, tmp_path, folder):
    path = str(tmp_path / "docs.parquet")
    rows = spark.createDataFrame([("a", "one", "en"), ("b", "two", "fr")], "id string, text string, lang string")
    rows.repartition(2).write.parquet(path) if folder else rows.toPandas().to_parquet(path)
    coll = new(payload="lang string")
    docs = ingest.text_stream(spark, path, rows.schema)
    ingest.store_stream(docs, coll, WAVE, checkpoint=str(tmp_path / "checkpoint"), payload=["lang"]).awaitTermination()
    assert ids(coll.read()) == ["a", "b"]


def test_batch_search_and_recommend(spark, new):
    coll = new(2)
    rows = [(f"k{i}", [float(i), 1.0]) for i in range(10)]
    coll.upsert(spark.createDataFrame(rows, "id string, vector array<double>"))
    queries = spark.createDataFrame([("q", [1.0, 0.0])], "query_id string, vector array<double>")
    assert [r["id"] for r in coll.search_batch(queries, 2).collect()] == ["k9", "k8"]
    assert "k9" not in ids(coll.recommend(["k9"], ["k0"], 3))


def test_failed_texts_are_reported(spark, new):
    def load():
        def model(batch):
            if any("bad" in t for t in batch):
                raise ValueError("refused")
            return [[1.0, 2.0] for _ in batch]

        return model

    coll = new(2)
    docs = texts(spark, [("a", "fine", 1), ("b", "bad", 1), (" ", "fine", 1), ("c", " ", 1)], "n int")
    with pytest.raises(RecordError):
        coll.store_memories(docs, PythonProvider(load))
    assert coll.count() == 0
    report, rejects = coll.store_memories(docs, PythonProvider(load), strict=False)
    assert ids(report) == ["a"]
    assert {r["reject_reason"] for r in rejects.collect()} == {"refused", "id_blank", "text_blank"}


def test_stream(spark, new, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    coll = new(payload="lang string")
    schema = "id string, text string, lang string"

    def run():
        docs = ingest.text_stream(spark, source, schema, files_per_batch=1)
        query = ingest.store_stream(docs, coll, WAVE, checkpoint=checkpoint, payload=["lang"])
        query.awaitTermination()

    for part in ([("a", "one", "en"), ("b", "two", "fr")], [("a", "three", "de"), ("c", " ", "en")]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
        run()
    assert {r["id"]: r["lang"] for r in coll.read().collect()} == {"a": "de", "b": "fr"}

    changes = coll._change_names()
    replay = spark.createDataFrame([("z", "late", "xx")], schema)
    done = int(coll.done("stream_texts"))
    writer = {}

    class Stream:
        """Hands over the function that stores a micro-batch."""

        writeStream = property(lambda self: self)  # noqa: N815

        def foreachBatch(self, function):  # noqa: N802
            writer["store"] = function
            return self

        def option(self, *_):
            return self

        def trigger(self, **_):
            return self

        def start(self):
            return None

    ingest.store_stream(Stream(), coll, WAVE, checkpoint=checkpoint, payload=["lang"])
    writer["store"](replay, done)
    assert coll._change_names() == changes
    writer["store"](replay, done + 1)
    assert "z" in ids(coll.read())


def test_shared_folder_is_read_from_the_session(spark):
    assert workspace.shared_folder(spark) == spark.conf.get(workspace.SETTING)
