import pytest


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def pairs(documents):
    return [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]


#: Names that operators use inside, as extra columns of the input.
CLASHING = ("n", "id", "row", "start", "bands", "class", "key", "word", "family", "content", "spans", "marks", "kept", "component")


@pytest.fixture(scope="session")
def odd(spark):
    """Null in every column, empty, blank and long texts, repeated rows and ids, clashing names."""
    long = " ".join(f"word{i % 997} and{i % 31}" for i in range(60_000))
    rows = [
        (1, "One two three four five six seven eight nine ten eleven twelve.", "en", "a", 10),
        (1, "One two three four five six seven eight nine ten eleven twelve.", "en", "a", 10),
        (2, None, "en", "a", None),
        (3, "", "de", None, 0),
        (4, " \n\t\r\v\f ", None, "b", 7),
        (5, long, "en", "b", len(long)),
        (6, long, "en", "b", len(long)),
        (7, "ein zwei drei vier fünf sechs sieben acht neun zehn elf", "de", "b", 1),
        (None, "no id here, but some words and a few more of them to make it longer", "en", None, 3),
        (8, "\U0001f600 \0 ünï ▁▁ x", "de", "c", 5),
        (8, "another text with the same id", "en", "c", 5),
        (9, "123 456 ... 7!", None, None, None),
    ]
    names = "doc_id long, text string, lang string, source string, n_chars long"
    frame = spark.createDataFrame(rows, names)
    for name in CLASHING:
        frame = frame.selectExpr("*", f"source AS `{name}`")
    return frame


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.where("false")
