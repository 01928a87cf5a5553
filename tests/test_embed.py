import hashlib
import math
import random
import re
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from semstore.errors import EmbeddingError, RecordError
from semstore.operators import counts, embed, search

# The model below is not importable on the workers.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
from stand_ins import WaveProvider


def wave(text, dim):
    units = np.frombuffer(text.encode("utf-16-be"), dtype=">u2").tolist()
    return [math.sin((units[i % len(units)] + i) * 0.1) for i in range(dim)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(1, "hello world"), (2, "a\U0001f600bé"), (3, "x" * 50), (4, " \t"), (5, None), (6, "y" * 100_001), (7, "z" * 100_000)]
    return spark.createDataFrame(rows, "id int, text string")


def test_wave_vectors(docs):
    made = {r["id"]: r for r in embed.embed(docs, WaveProvider(20), max_length=100_000).collect()}
    for r in docs.where("id in (1, 2, 3, 7)").collect():
        assert made[r["id"]]["vector"] == pytest.approx(wave(r["text"], 20)) and made[r["id"]]["error"] is None
    assert made[4]["error"] == made[5]["error"] == "text_blank" and made[4]["vector"] is None
    assert made[6]["error"] == "text_too_long_to_embed"


def load():
    calls = []

    def model(texts):
        calls.append(len(texts))
        if any("!" in t for t in texts):
            raise ValueError("no exclamations")
        return [
            [] if t == "empty" else [float("nan")] if t == "nan" else [float(len(t)), float(len(calls) > 0)] for t in texts
        ]

    return model


def test_python_provider_keeps_errors_apart(spark):
    texts = ["one", "two!", "empty", "nan", "", "four"]
    df = spark.createDataFrame([(i, t, {"k": i}) for i, t in enumerate(texts)], "id int, text string, extra map<string,int>")
    made = embed.embed(df, embed.PythonProvider(load, batch_size=4))
    assert made.columns == ["id", "text", "extra", "vector", "error"]
    got = {r["text"]: (r["vector"], r["error"]) for r in made.collect()}
    assert got == {
        "one": ([3.0, 1.0], None),
        "two!": (None, "no exclamations"),
        "empty": (None, "no_vector"),
        "nan": (None, "vector_not_finite"),
        "": (None, "text_blank"),
        "four": ([4.0, 1.0], None),
    }
    assert counts.embedding_totals(made).first().asDict() == {"success_count": 2, "failure_count": 4}


def test_python_provider_with_a_variant_beside(spark):
    df = spark.createDataFrame([(1, "one", '{"a": 1}')], "id int, text string, j string").select(
        "id", "text", F.parse_json("j").alias("payload")
    )
    row = embed.embed(df, embed.PythonProvider(load)).select(F.to_json("payload"), "vector").first()
    assert tuple(row) == ('{"a":1}', [3.0, 1.0])


def test_hashing_provider_finds_related_texts(spark):
    rows = [(1, "machine learning models"), (2, "deep learning models"), (3, "cooking pasta recipes"), (4, "garden flowers")]
    df = spark.createDataFrame(rows, "id int, text string")
    provider = embed.HashingProvider.fit(df, dim=4096)
    coll = embed.embed(df, provider).drop("error")
    found = search.search_text(coll, "learning models for machines", provider, 2).collect()
    assert {r["id"] for r in found} == {1, 2}


def test_hashing_reads_whole_texts(spark):
    head = "word " * 3_000
    rows = [(1, head + "alpha"), (2, head + "beta"), (3, "..."), (4, "word"), (5, "t " * 1_000_000 + "gamma")]
    df = spark.createDataFrame(rows, "id int, text string")
    provider = embed.HashingProvider.fit(df, dim=64)
    made = {r["id"]: r for r in embed.embed(df, provider).collect()}
    assert made[1]["vector"] != made[2]["vector"] and made[3]["error"] == embed.NO_WORDS and made[3]["vector"] is None
    place = int(hashlib.md5(b"gamma").hexdigest()[:8], 16) % 64
    assert made[5]["vector"][place] > 0


def test_search_memory(spark):
    rows = [(1, "alpha", "A", None), (2, "beta", "B", " kept "), (3, "alphabet", "A", None)]
    df = spark.createDataFrame(rows, "id int, title string, kind string, content string")
    provider = WaveProvider(16)
    coll = embed.embed(df, provider, "title").drop("error")
    found = search.search_memory(coll, " alpha ", provider, where={"kind": "A"}).collect()
    assert [r["id"] for r in found] == [1, 3]
    assert found[0]["score"] == pytest.approx(1) and found[0]["text"] == "alpha" and found[0]["payload"]["kind"] == "A"
    assert {(r["total_results"], r["has_filter"]) for r in found} == {(2, True)}
    assert search.search_memory(coll, "beta", provider, 1).first()["text"] == "kept"


@pytest.mark.parametrize("arguments", [("", 5), ("  ", 5), ("q" * 10_001, 5), ("q", 0), ("q", 1001), ("q", 2.5), (None, 5)])
def test_search_memory_refuses(spark, docs, arguments):
    with pytest.raises(RecordError):
        search.search_memory(docs, arguments[0], WaveProvider(4), arguments[1])


def test_search_memory_refuses_a_filter_that_is_no_dict(docs):
    with pytest.raises(RecordError):
        search.search_memory(docs, "q", WaveProvider(4), 5, [1])


def test_provider_arguments():
    with pytest.raises(EmbeddingError):
        WaveProvider(0)
    with pytest.raises(EmbeddingError):
        embed.PythonProvider(load, batch_size=0)


def test_a_native_vector_is_computed_once(docs):
    """However the result is filtered, the expression stands in the plan once."""
    made = embed.embed(docs, WaveProvider(20)).where("error IS NULL").where("vector[0] > -2").select("id", "vector")
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.upper().count("SIN(") == 1
    assert sorted(r["id"] for r in made.collect()) == [1, 2, 3, 6, 7]


def test_hashing_embeds_once_and_equals_its_definition(spark):
    texts = ["The cat, the dog_and the bird", "a cat", "ÉTÉ été 12 ½ x²", "...", "", None, "the"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    provider = embed.HashingProvider.fit(df, dim=32)
    made = embed.embed(df, provider).where("error IS NULL")
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1
    place = lambda w: int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % 32
    words = [["the", "cat", "the", "dog", "and", "the", "bird"], ["a", "cat"], ["été", "été", "12", "½", "x²"], [], [], [], ["the"]]
    seen = [sum(any(place(w) == p for w in own) for own in words) for p in range(32)]
    weights = [math.log((len(texts) + 1) / (n + 1)) for n in seen]
    assert provider.weights.tolist() == pytest.approx(weights)
    got = {r["id"]: r["vector"] for r in made.collect()}
    for i, own in enumerate(words):
        vector = np.zeros(32)
        for w in own:
            vector[place(w)] += weights[place(w)]
        if vector.any():
            assert got.pop(i) == pytest.approx((vector / np.linalg.norm(vector)).tolist())
    assert got == {}
    errors = {r["id"]: r["error"] for r in embed.embed(df, provider).collect()}
    assert errors[3] == embed.NO_WORDS and errors[4] == errors[5] == "text_blank"
    empty = embed.HashingProvider.fit(df.where("false"), dim=4)
    assert empty.weights.tolist() == [0.0] * 4


def test_a_text_is_embedded_once_over_batches(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def load():
        def model(texts):
            calls.add(len(texts))
            if any("bad" in t for t in texts):
                raise ValueError("refused")
            return [[float(len(t)), 1.0] for t in texts]

        return model

    provider, store = embed.PythonProvider(load, batch_size=1), str(tmp_path / "store")
    first = [(i, f"text {i % 3}") for i in range(300)] + [(300, "bad"), (301, None), (302, " ")]
    one = embed.embed_once(spark.createDataFrame(first, "id int, text string").repartition(5), provider, store)
    rows = {r["id"]: (r["vector"], r["error"]) for r in one.collect()}
    assert len(rows) == 303 and rows[299] == ([6.0, 1.0], None) and rows[300] == (None, "refused")
    assert rows[301] == rows[302] == (None, "text_blank") and calls.value == 4
    two = embed.embed_once(spark.createDataFrame([(1, "text 1"), (2, "a new one"), (3, "bad")], "id int, text string"), provider, store)
    assert {r["id"]: r["vector"] for r in two.collect()} == {1: [6.0, 1.0], 2: [9.0, 1.0], 3: None}
    assert calls.value == 6 and spark.read.parquet(store).count() == 4
    assert embed.embed_once(two.select("id", "text").where("false"), provider, store).count() == 0
    plain = embed.embed(spark.createDataFrame(first, "id int, text string"), provider).collect()
    assert {r["id"]: (r["vector"], r["error"]) for r in plain} == rows


def test_words_are_counted_on_their_places_however_texts_are_cut(monkeypatch):
    def defined(text):
        found = [0] * 13
        for word in re.findall(r"[^\W_]+", text.lower()):
            found[int(hashlib.md5(word.encode(errors="replace")).hexdigest()[:8], 16) % 13] += 1
        return found

    draw = random.Random(5)
    letters = list("abcé Σςİ_ \n²½文٣𝒳😀\u0301\u200b\ud800") + [" ", "a", "b"] * 10
    texts = ["".join(draw.choices(letters, k=draw.randint(0, 60))) for _ in range(300)] + ["", "_", "ΑΣ", "a" * 100]
    for size in (1, 7, 500, 1 << 21):
        monkeypatch.setattr(embed, "_TOGETHER", size)
        assert embed._Places(13).counts(texts).tolist() == [defined(t) for t in texts]
    assert embed._Places(13).counts([]).shape == (0, 13)
