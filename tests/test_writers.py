"""Several writers, versions in any order, rejects of streams, fields of any name, and collections with cells."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from semstore import Collection, RecordError
from semstore.errors import ConflictError
from semstore.operators import embed, knn, shred, store
from semstore.operators.filters import predicate
from semstore.sources.commits import Commits, State
from semstore.streaming import ingest
from stand_ins import WaveProvider

WAVE = WaveProvider(8)
VECTORS = "id string, vector array<double>"


@pytest.fixture
def new(spark):
    made = []

    def create(dim=1, distance="Cosine", **options):
        made.append(f"w_{uuid.uuid4().hex}")
        return Collection.create(spark, made[-1], dim, distance, **options)

    yield create
    for name in made:
        if Collection.exists(spark, name):
            Collection.drop(spark, name)


def one(spark, id_, value=1.0, **fields):
    row = spark.createDataFrame([(id_, [value])], VECTORS)
    return row.withColumns({k: F.lit(v) for k, v in fields.items()})


def ids(df):
    return sorted(r["id"] for r in df.collect())


def meanwhile(monkeypatch, coll, action, times=1):
    """Let another writer act between the reading of the state and the commit of `coll`."""
    left, publish = [times], coll._commits.publish

    def late(state, number):
        if left[0]:
            left[0] -= 1
            action()
        return publish(state, number)

    monkeypatch.setattr(coll._commits, "publish", late)


def test_a_commit_is_made_once(spark, tmp_path):
    commits = Commits(spark, str(tmp_path / "root"))
    assert commits.publish(State("a"), 1) and not commits.publish(State("b"), 1)
    assert commits.last() == State("a", number=1)
    assert commits.publish(State("c", (("x", 5),), ("y",), "z", ("f",), "r", {"k": "v"}), 2)
    assert Commits(spark, str(tmp_path / "root")).last() == State("c", (("x", 5),), ("y",), "z", ("f",), "r", {"k": "v"}, 2)
    commits.forget_before(2)
    assert sorted(f.name for f in (tmp_path / "root" / "_commits").iterdir() if f.name[0] != ".") == [f"{2:020d}"]


def test_both_of_two_writers_count(spark, new, monkeypatch):
    coll = new(payload="n int")
    other = Collection(spark, coll.name)
    meanwhile(monkeypatch, coll, lambda: other.upsert(one(spark, "b", n=2)))
    coll.upsert(one(spark, "a", n=1))
    assert ids(coll.read()) == ids(other.read()) == ["a", "b"]
    # the same record: the one that commits last wins, whole
    meanwhile(monkeypatch, coll, lambda: other.upsert(one(spark, "c", 2.0, n=2)))
    coll.upsert(one(spark, "c", 3.0, n=None))
    assert [(r["vector"], r["n"]) for r in other.get(["c"], with_vector=True).collect()] == [([3.0], None)]


def test_a_change_that_reads_is_made_anew(spark, new, monkeypatch):
    coll = new(payload="n int, tag string")
    other = Collection(spark, coll.name)
    coll.upsert(one(spark, "a", n=1, tag="x").union(one(spark, "b", n=2, tag="x")))
    meanwhile(monkeypatch, coll, lambda: other.upsert(one(spark, "a", 5.0, n=7, tag="y")))
    coll.update_where({"n": {"lt": 3}}, {"tag": "small"})
    # what the other writer has stored is neither lost nor changed
    assert {r["id"]: (r["n"], r["tag"]) for r in coll.read().collect()} == {"a": (7, "y"), "b": (2, "small")}
    meanwhile(monkeypatch, coll, lambda: other.upsert(one(spark, "c", n=1, tag="z")))
    coll.delete_where({"n": 1})
    assert ids(coll.read()) == ["a", "b"]


def test_rewriting_keeps_what_others_commit(spark, new, monkeypatch):
    coll = new(payload="n int", compact_after=3)
    other = Collection(spark, coll.name)
    coll.upsert(one(spark, "a", n=1))
    meanwhile(monkeypatch, coll, lambda: other.upsert(one(spark, "b", n=2)))
    coll.compact()
    assert ids(coll.read()) == ["a", "b"]
    coll.upsert(one(spark, "c", n=3))
    meanwhile(monkeypatch, coll, lambda: other.upsert(one(spark, "d", n=4)), times=1)
    coll.upsert(one(spark, "e", n=5))  # folds
    assert ids(coll.read()) == ["a", "b", "c", "d", "e"]
    meanwhile(monkeypatch, coll, lambda: other.upsert(one(spark, "f", n=6)), times=10**6)
    with pytest.raises(ConflictError):
        coll.upsert(one(spark, "g", n=7))
    assert "f" in ids(other.read()) and "g" not in ids(other.read())


def test_versions_may_arrive_in_any_order(spark, new):
    """Shuffled arrival gives the same collection as sorted arrival, over batches, folds and rewriting."""
    drawn = random.Random(3)
    rows = [(f"k{drawn.randint(0, 9)}", [float(i)], i) for i in range(40)]
    want = {id_: n for id_, _, n in rows}
    schema = f"{VECTORS}, at int"
    for seed in range(2):
        coll = new(payload="at int", version="at", compact_after=4)
        random.Random(seed).shuffle(rows)
        for start in range(0, 40, 7):
            coll.upsert(spark.createDataFrame(rows[start : start + 7], schema))
        assert {r["id"]: r["at"] for r in coll.read().collect()} == want
        coll.compact()
        coll.upsert(spark.createDataFrame([("k1", [0.0], -5), ("k2", [0.0], None)], schema))
        assert {r["id"]: r["at"] for r in coll.read().collect()} == want
    coll.delete(["k1"])
    assert "k1" not in ids(coll.read())
    coll.upsert(spark.createDataFrame([("k1", [1.0], -9)], schema))  # committed after the deletion
    assert {r["id"]: r["at"] for r in coll.read().collect()} == {**want, "k1": -9}
    with pytest.raises(RecordError):
        new(version="missing")


def test_a_stream_out_of_order_and_its_rejects(spark, new, tmp_path):
    coll = new(8, payload="turn int", version="turn")
    schema = "id string, text string, turn int"
    parts = [[("a", "third", 3), ("b", "only", 1)], [("a", "first", 1), ("c", " ", 1), ("", "no id", 1)], [("a", "second", 2), ("c", "now", 2)]]
    docs = ingest.text_stream(spark, str(tmp_path / "in"), schema, files_per_batch=1)
    options = {"checkpoint": str(tmp_path / "checkpoint"), "rejects": str(tmp_path / "rejects"), "payload": ["turn"]}
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        ingest.store_stream(docs, coll, WAVE, **options).awaitTermination()
    assert {r["id"]: r["turn"] for r in coll.read().collect()} == {"a": 3, "b": 1, "c": 2}
    rejects = spark.read.parquet(str(tmp_path / "rejects"))
    assert sorted((r["id"], r["reject_reason"], r["batch"]) for r in rejects.collect()) == [("", "id_blank", 1), ("c", "text_blank", 1)]


def test_fields_of_any_name_are_updated(spark, new):
    coll = new(payload="n int")
    coll.upsert(one(spark, "a", n=1, colour="red", size=3).union(one(spark, "b", n=2, colour="blue", size=4)))
    coll.upsert(one(spark, "c", n=1))
    coll.update_where({"n": 1}, {"colour": "green", "tags": ["x", 1], "n": 5})
    assert coll.count({"colour": "green"}) == 2 and coll.count({"colour": "blue"}) == 1 and coll.count({"n": 5}) == 2
    assert ids(coll.read().where("to_json(payload) LIKE '%\"size\":3%'")) == ["a"]
    got = {r["id"]: r["p"] for r in coll.read().select("id", F.to_json("payload").alias("p")).collect()}
    assert got["c"] == '{"colour":"green","tags":["x",1]}' and '"tags":["x",1]' in got["a"] and "tags" not in got["b"]


@pytest.mark.parametrize("distance", ["Cosine", "Euclidean"])
def test_a_collection_with_cells(spark, new, distance):
    drawn = random.Random(4)
    rows = [(f"k{i:03d}", [drawn.gauss(i % 6 * 5 - 12, 1), drawn.gauss(i % 5 * 5 - 10, 1), drawn.gauss(0, 1)], i % 4) for i in range(400)]
    schema = f"{VECTORS}, n int"
    coll = new(3, distance, payload="n int")
    with pytest.raises(RecordError, match="index_cells"):
        coll.search([1.0, 0.0, 0.0], effort=2)
    coll.upsert(spark.createDataFrame(rows[:300], schema))
    coll.index_cells(20)
    coll.upsert(spark.createDataFrame(rows[300:], schema))  # into the same cells
    coll.delete(["k000"])
    assert coll._current().where("_cell IS NULL").count() == 0 and coll.read().columns == ["id", "vector", "n", "payload"]
    queries = spark.createDataFrame([(i, r[1]) for i, r in enumerate(rows[::40])], "query_id int, vector array<double>")
    every = lambda df: sorted(map(tuple, df.collect()))
    exact = every(coll.search_batch(queries, 4, payload=["n"]))
    assert every(coll.search_batch(queries, 4, payload=["n"], prune=True)) == exact
    assert every(coll.search_batch(queries, 4, payload=["n"], effort=20)) == exact
    assert every(coll.search_batch(queries, 4, where={"n": 1}, prune=True)) == every(coll.search_batch(queries, 4, where={"n": 1}))
    few = {(r.query_id, r.id) for r in coll.search_batch(queries, 4, effort=4).collect()}
    assert len(few & {(r[0], r[1]) for r in exact}) >= 0.8 * len(exact)
    vector = rows[80][1]
    assert [r["id"] for r in coll.search(vector, 1, effort=1).collect()] == ["k080"]
    coll.compact()
    found = coll.search(vector, 3, effort=2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(_cell," in plan
    assert every(coll.search_batch(queries, 4, payload=["n"], prune=True)) == exact
    with pytest.raises(RecordError):
        coll.search_batch(queries, 4, effort=0)
    with pytest.raises(RecordError):
        coll.search_batch(queries, 4, effort=2, prune=True)


def test_each_search_of_a_batch_has_its_own_options(spark):
    coll = spark.createDataFrame([(f"k{i}", [float(i), 1.0], i) for i in range(10)], f"{VECTORS}, n int")
    asked = [("a", [1.0, 0.0], 2, None), ("b", [1.0, 0.0], None, 0.99), ("c", [0.0, 1.0], 3, 0.9), ("d", [0.0, 1.0], None, None)]
    queries = spark.createDataFrame(asked, "query_id string, vector array<double>, top_k int, score_threshold double")
    rows = knn.search_batch(coll, queries, payload=["n"], with_vector=True).collect()
    by_query = {q: [r for r in rows if r.query_id == q] for q in "abcd"}
    assert len(by_query["a"]) == 2 and {r.id for r in by_query["b"]} == {"k9", "k8"} and {r.id for r in by_query["c"]} == {"k0"}
    assert len(by_query["d"]) == 10 and all(r.vector == [float(r.n), 1.0] for r in rows)
    near = knn.search_batch(coll, queries.drop("top_k"), 4, metric="euclidean").collect()
    assert {r.id for r in near if r.query_id == "c"} == {"k0"} and len([r for r in near if r.query_id == "a"]) == 4


def test_promoted_fields_reach_the_scan(spark, new):
    rows = [(f"k{i:02d}", [1.0], f'{{"colour": "{"red" if i % 3 else "blue"}", "size": {i}, "on": {str(i % 2 == 0).lower()}}}') for i in range(40)]
    rows += [("t", [1.0], '{"colour": ["red", 7], "size": "12", "on": "true"}'), ("u", [1.0], '{"colour": null, "size": 2.5}'), ("v", [1.0], None)]
    batch = spark.createDataFrame(rows, f"{VECTORS}, j string").select("id", "vector", F.try_parse_json("j").alias("payload"))
    coll = new()
    coll.upsert(batch)
    wheres = [
        {"colour": "red"}, {"colour": ["blue", 7]}, {"size": {"gte": 30}}, {"size": "12"}, {"size": 12}, {"size": {"lt": 3, "gte": 2}},
        {"on": True}, {"on": "true"}, {"must_not": [{"match": {"key": "colour", "value": "red"}}]}, {"colour": "red", "size": {"lt": 9}},
        {"colour": [True, "blue"]}, {"missing": 1},
    ]
    want = [ids(coll.read().where(predicate(coll.read(), w))) for w in wheres]
    assert [r.field for r in shred.frequent_fields(coll.read()).limit(3).collect()] == ["colour", "size", "on"]
    coll.promote("colour", "size", "on")
    assert coll.read().columns == ["id", "vector", "payload"]
    found = lambda: [ids(coll._current().where(predicate(coll._current(), w))) for w in wheres]
    assert found() == want and want[0] and want[6]
    # later changes have the columns too, and a change that came without them is asked by its payload
    coll.upsert(batch.where("id < 'k05'"))
    assert found() == want and coll.count({"size": {"gte": 30}}) == len(want[2])
    coll.compact()
    rows_ = coll._current()
    text, number = (rows_.where(predicate(rows_, w))._jdf.queryExecution().executedPlan().toString() for w in (wheres[0], wheres[2]))
    assert "EqualTo(_text_of_colour,red)" in text and "GreaterThanOrEqual(_number_of_size,3" in number
    older = rows_.withColumn("_rest_of_colour", F.lit(None).cast("boolean")).withColumn("_text_of_colour", F.lit(None).cast("string"))
    assert ids(older.where(predicate(older, wheres[0]))) == want[0]
    coll.update_where({"colour": "blue"}, {"colour": "green"})
    assert coll.count({"colour": "green"}) == 14 and coll.count({"colour": "blue"}) == 0
    with pytest.raises(RecordError):
        coll.promote("a b")


def test_pages_read_the_files_they_need(spark, new):
    coll = new(payload="n int", compact_after=50)
    rows = spark.range(400).selectExpr("concat('k', lpad(id, 4, '0')) AS id", "array(1D) AS vector", "cast(id AS int) AS n")
    coll.upsert(rows)
    with_changes = [f"k{i:04d}" for i in range(400)]

    def pages(limit, **options):
        out, offset = [], None
        while page := coll.scroll(limit=limit, offset=offset, **options).collect():
            assert [r["id"] for r in page] == sorted(r["id"] for r in page) and len(page) <= limit
            out += [r["id"] for r in page]
            offset = page[-1]["id"]
        return out

    assert pages(150) == with_changes
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "20")
    try:
        coll.compact()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    files = len(coll._base(coll._state()).inputFiles())
    first, later = coll.scroll(limit=10), coll.scroll(limit=10, offset="k0200")
    assert files >= 15 and len(first.inputFiles()) <= 4 and len(later.inputFiles()) <= 5
    assert pages(150) == with_changes
    coll.delete_where({"n": {"gte": 30, "lt": 330}})
    coll.upsert(rows.where("id = 'k0100'").union(spark.createDataFrame([("a", [1.0], 0), ("z", [1.0], 0), ("k0010x", [1.0], 0)], rows.schema)))
    left = sorted(["a", "z", "k0010x", "k0100", *(f"k{i:04d}" for i in range(400) if not 30 <= i < 330)])
    assert pages(37) == left
    assert pages(20, where={"n": {"lt": 20}}) == [i for i in left if i in ("a", "z", "k0010x") or i < "k0020"]
    assert coll.scroll(limit=5, offset="zz").collect() == []


def test_a_get_of_many_ids_names_them_to_the_scan(spark, new):
    coll = new()
    coll.upsert(spark.range(3000).selectExpr("concat('k', id) AS id", "array(1D) AS vector"))
    coll.compact()
    wanted = [f"k{i}" for i in range(0, 3000, 100)]
    found = coll.get(wanted)
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan[plan.index("PushedFilters") :]
    assert "Or(" in pushed and pushed.count("In(id, [") >= 3
    assert ids(found) == sorted(wanted)


def test_python_gets_a_text_once_and_no_measures(spark):
    docs = spark.createDataFrame([("1", "one two", "en")], "id string, text string, lang string")
    made = store.store_memories(docs, embed.HashingProvider([1.0] * 4), payload=["lang"])
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    (line,) = [line for line in plan.splitlines() if "MapInArrow" in line]
    assert "_source" in line and "_analysis" not in line and "text#" not in line
    row = made.first()
    assert (row["text"], row["_word_count"], row["_analysis"]["word_count"], row["reject_reason"]) == ("one two", 2, 2, None)


def test_the_model_gets_as_many_texts_as_it_wants_and_rows_stay_in_order(spark):
    texts = ["a", None, "bb", "", "ccc", "dddd", None, "eeeee", "bad", "f"]
    docs = spark.createDataFrame(list(enumerate(texts)), "n int, text string").coalesce(1)

    def load():
        def model(given):
            if "bad" in given:
                raise ValueError("no")
            return [[float(len(t)), float(len(given))] for t in given]

        return model

    got = [(r["n"], r["vector"], r["error"]) for r in embed.embed(docs, embed.PythonProvider(load, 3), spread=False).orderBy("n").collect()]
    blank = "text_blank"
    # of the second three texts the last is bad: halves are tried, dddd alone, then eeeee and bad, then each of them
    want = [[1.0, 3.0], blank, [2.0, 3.0], blank, [3.0, 3.0], [4.0, 1.0], blank, [5.0, 1.0], "no", [1.0, 1.0]]
    assert got == [(n, None, w) if isinstance(w, str) else (n, w, None) for n, w in enumerate(want)]


def test_the_flags_meet_the_report_and_not_the_texts(spark, new):
    coll = new(4, payload="text string")
    docs = spark.createDataFrame([("1", "one"), ("2", "two"), ("3", None)], "id string, text string")
    provider = embed.HashingProvider([1.0] * 4)
    coll.store_memories(docs.where("id = '1'"), provider)
    report, rejects = coll.store_memories(docs, provider, strict=False)
    assert {(r["id"], r["was_update"], r["text_length"]) for r in report.collect()} == {("1", True, 3), ("2", False, 3)}
    assert spark.read.parquet(*report.inputFiles()).columns == ["id", "vector_dimensions", "was_update", "text_length", "payload_keys"]
    assert [(r["id"], r["reject_reason"]) for r in rejects.collect()] == [("3", "text_blank")]
