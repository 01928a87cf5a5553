"""Text measures against plain Python on awkward texts."""

import re

import pytest
from pyspark.sql import functions as F

from semstore.errors import EmbeddingError
from semstore.functions import models
from semstore.functions import text as measures
from semstore.operators import search, store

TEXTS = [
    "Hello, world.",
    "  spaced\tout text \n",
    "a\U0001f600b",
    "one\ntwo\n\nfour\n",
    "Wait... what?! Yes.  ",
    "",
    " ﻿　 ",
    "see https://example.org or mail me@host.org",
    "ÉTÉ an été",
    "theory of éof",
    "étheé",
    "12",
    "\u212athe",
    "\u0130n The",
    "\u0130n",
    "x" * 5000,
    "word " * 2000,
]
WS = "".join(map(re.escape, measures.WHITE_SPACE))


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    t = F.col("t")
    return df.select(
        "i", measures.analysis(t).alias("a"), measures.word_count(t).alias("w"), measures.trim(t).alias("trimmed"),
        measures.is_blank(t).alias("blank"), measures.utf16_length(t).alias("n"),
    ).orderBy("i").collect()


def test_trim_and_blank(rows):
    for text, row in zip(TEXTS, rows, strict=True):
        assert row["trimmed"] == text.strip(measures.WHITE_SPACE)
        assert row["blank"] == (not text.strip(measures.WHITE_SPACE))


def test_counts(rows):
    for text, row in zip(TEXTS, rows, strict=True):
        units = len(text.encode("utf-16-be")) // 2
        split = re.split(f"[{WS}]+", text.strip(measures.WHITE_SPACE))
        words = [w for w in split if w]
        sentences = [s for s in re.split("[.!?]+", text) if s.strip(measures.WHITE_SPACE)]
        a = row["a"]
        assert row["n"] == a["character_count"] == units
        assert row["w"] == len(words) and a["word_count"] == len(split)
        assert a["line_count"] == text.count("\n") + 1
        assert a["sentence_count"] == len(sentences)
        assert a["avg_word_length"] == units / len(split)


def test_flags(rows):
    for text, row in zip(TEXTS, rows, strict=True):
        a, h = row["a"], row["a"]["language_hints"]
        assert a["contains_urls"] == bool(re.search("https?://", text))
        assert a["contains_emails"] == bool(re.search(r"@\w+\.\w+", text, re.A))
        assert a["contains_numbers"] == bool(re.search(r"\d", text, re.A))
        words = "|".join(measures.ENGLISH_WORDS)
        assert h["likely_english"] == bool(re.search(rf"\b({words})\b", text.lower(), re.A))
        assert h["has_punctuation"] == bool(re.search("[.,;:!?]", text))
        assert h["has_capitalization"] == bool(re.search("[A-Z]", text))


def test_result_text(spark):
    df = spark.createDataFrame(
        [(1, None, " ", "b"), (2, 5, "c ", "b"), (3, None, None, None)], "id int, text int, content string, body string"
    )
    found = [r[0] for r in df.orderBy("id").select(search.result_text(df)).collect()]
    assert found == ["b", "c", None]


@pytest.mark.parametrize(
    "payload, kept",
    [
        ({"text": "own", "content": None}, "own"),
        ({"text": "", "content": None}, "SOURCE"),
        ({"text": None, "content": "given"}, None),
        ({"text": "", "content": "given"}, ""),
        ({"text": None, "content": ""}, "SOURCE"),
    ],
)
def test_enrich_keeps_the_text_once(spark, payload, kept):
    docs = spark.createDataFrame([("SOURCE", *payload.values())], "body string, text string, content string")
    row = store.enrich(docs, text_col="body", payload=["text", "content"], stored_at=F.lit("now")).first()
    assert row["text"] == kept and row["_stored_at"] == "now" and row["_text_length"] == 6
    assert row["_analysis"]["word_count"] == row["_word_count"] == 1


def test_enrich_overwrites_its_own_keys(spark):
    docs = spark.createDataFrame([("some text", "mine")], "text string, _word_count string")
    row = store.enrich(docs).first()
    assert row["_word_count"] == 2 and row["text"] == "some text"
    assert row["_stored_at"] is not None


def test_costs(spark):
    df = spark.createDataFrame([(1, "text-embedding-ada-002"), (4001, "text-embedding-3-large"), (9, "nope")], "n int, m string")
    made = models.with_model(df, F.col("m")).select(
        "n", models.estimated_tokens(F.col("n")).alias("t"), models.estimated_cost(F.col("n"), F.col("price_per_1k")).alias("c")
    )
    got = {r["n"]: (r["t"], r["c"]) for r in made.collect()}
    assert got[1] == (1, pytest.approx(0.0000001)) and got[4001] == (1001, pytest.approx(1.001 * 0.00013))
    assert got[9] == (3, None)
    assert models.with_model(df, "all-minilm").first()["dimensions"] == 384


def test_expected_dimensions():
    assert models.expected_dimensions("text-embedding-3-small") == 1536
    assert models.expected_dimensions("text-embedding-3-small", 256) == 256
    assert models.expected_dimensions("nope") is None and models.expected_dimensions("nope", 8) == 8
    for model, override in (("text-embedding-ada-002", 256), ("text-embedding-3-small", 0)):
        with pytest.raises(EmbeddingError):
            models.expected_dimensions(model, override)
