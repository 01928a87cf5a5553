"""The pipeline against a brute-force version, and the registered queries."""

import duckdb
import numpy as np
import public_tokenizers
import sentencepiece

import __spark_entry__
import corpus_pipeline
from semstore.llm import pii, quality
from semstore.llm.common import table
from semstore.llm.queries import ORACLES, QUERIES
from tests.llm import brute


def test_registered():
    assert {f"op{n}_" for n in range(1, 14)} == {q.split("_")[0] + "_" for q in QUERIES if q.startswith("op")}
    assert QUERIES.items() <= __spark_entry__.queries().items() and "pipeline" in QUERIES
    assert [len(s) for s in corpus_pipeline.STAGES] == [2] * 5


def test_sql_gives_the_same_rows(spark, sf_dir):
    connection = duckdb.connect()
    for name in ("documents", "benchmark"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    for name, sql in ORACLES.items():
        found = QUERIES[name](spark, sf_dir)
        cursor = connection.execute(sql)
        columns = [d[0] for d in cursor.description]
        assert sorted(columns) == sorted(found.columns)
        assert sorted(cursor.fetchall(), key=repr) == sorted(map(tuple, found.select(*columns).collect()), key=repr)


def test_pipeline(spark, sf_dir, documents, pairs):
    texts = dict(pairs)
    judged = quality.quality(documents, table(spark, sf_dir, "labels")).collect()
    left = [i for i in texts if next(r.kept for r in judged if r.doc_id == i)]
    single = brute.near_duplicates([(i, texts[i]) for i in left], size=5)
    left = [i for i in left if single[i][2]]
    items = [tuple(r) for r in table(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
    hit = brute.contamination([(i, texts[i]) for i in left], items)
    left = [i for i in left if not hit[i][4]]
    model = pii.fit(documents.where(documents.doc_id.isin(left)).select("doc_id", "text"))
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = {}
    for i in left:
        text = pii.redacted(texts[i], sum(pii.find_all(texts[i], model, {}), []))
        ids = library.encode(text, add_bos=True, add_eos=True)
        want[i] = (len(ids), brute.sha(np.array(ids, dtype="<u4").tobytes()), brute.sha(library.decode(ids)))
    found = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found} == want


def test_stages_keep_the_columns(spark, sf_dir, documents):
    docs = documents
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == documents.columns and docs.dtypes == documents.dtypes


def test_one_row_of_each_group_stays(spark):
    """Rows are told apart by themselves: repeated and missing ids neither lose a text nor keep a copy."""
    words = [f"w{i}" for i in range(100)]
    base, near = " ".join(words), " ".join(["other", *words[1:]])
    rows = [
        (5, base), (3, near), (3, "a text of its own that shares an id with a near copy"), (7, base), (7, base),
        (None, base), (None, "without an id"), (None, "without an id"), (None, "without an id too"), (None, ""), (None, None),
    ]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = corpus_pipeline.near_duplicates_out(spark, docs, "")
    assert left.columns == docs.columns
    kept = sorted(((r.doc_id, r.text) for r in left.collect()), key=repr)
    want = [(3, near), (3, rows[2][1]), (None, "without an id"), (None, "without an id too"), (None, ""), (None, None)]
    assert kept == sorted(want, key=repr)
    assert corpus_pipeline.near_duplicates_out(spark, docs.where("false"), "").count() == 0
