"""Look-up, upsert, deletion, update, paging, validation, and collections from end to end."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from semstore.operators import counts, filters, quality, records
from semstore.operators.embed import HashingProvider, PythonProvider, embed_once
from semstore.plans import workspace
from semstore.plans.workload.registry import register, table
from semstore.plans.workload.texts import hashed
from semstore.sources.collection import Collection
from semstore.streaming import ingest


def _documents(spark, folder):
    return table(spark, folder, "documents")


def _toxic_ids(spark, folder):
    labels = table(spark, folder, "labels")
    return labels.where(F.col("toxic") == 1).select("doc_id")


@register(
    """
    SELECT doc_id, 0.0::DOUBLE AS score, lang, source, n_chars FROM documents
    WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)
    """
)
def get_by_ids(spark, folder):
    """The documents whose ids are listed in another table."""
    docs = _documents(spark, folder).drop("text")
    return records.get_by_ids(docs, _toxic_ids(spark, folder), id_col="doc_id")


@register("SELECT doc_id, 0.0::DOUBLE AS score, lang FROM documents WHERE doc_id IN (3, 17, 42)")
def get_by_id_list(spark, folder):
    """Ids as given by a caller: trimmed, the unknown ones missing from the result."""
    docs = _documents(spark, folder).select("doc_id", "lang")
    return records.get_by_ids(docs, ["3", " 17 ", "42", "42", "none"], id_col="doc_id")


@register("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def delete_by_ids(spark, folder):
    docs = _documents(spark, folder).select("doc_id", "lang")
    return records.delete_by_ids(docs, _toxic_ids(spark, folder), "doc_id")


@register("SELECT doc_id, lang, n_chars FROM documents WHERE NOT (lang = 'en' AND n_chars < 500)")
def delete_by_filter(spark, folder):
    docs = _documents(spark, folder).select("doc_id", "lang", "n_chars")
    return records.delete_by_filter(docs, {"lang": "en", "n_chars": {"lt": 500}})


@register(
    """
    SELECT doc_id, CASE WHEN n_chars > 1000 THEN 'long' ELSE lang END AS lang,
           CASE WHEN n_chars > 1000 THEN 1 ELSE 0 END AS reviewed FROM documents
    """
)
def update_payload(spark, folder):
    docs = _documents(spark, folder).select("doc_id", "lang", "n_chars").withColumn("reviewed", F.lit(0))
    changed = records.update_payload(docs, {"n_chars": {"gt": 1000}}, {"lang": "long", "reviewed": 1})
    return changed.drop("n_chars")


@register("SELECT doc_id, lang FROM documents WHERE doc_id > 40 AND lang = 'en' ORDER BY doc_id LIMIT 25")
def scroll_page(spark, folder):
    docs = _documents(spark, folder).select("doc_id", "lang")
    return records.scroll(docs, where={"lang": "en"}, limit=25, offset=40, id_col="doc_id")


@register(
    """
    WITH r AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role = 'assistant' ORDER BY turn DESC) AS n
               FROM conversations),
    newest AS (SELECT * FROM r WHERE n = 1),
    kept AS (SELECT * FROM newest WHERE role = 'assistant' OR conv_id NOT IN
             (SELECT conv_id FROM newest WHERE role = 'assistant'))
    SELECT conv_id, turn, role, length(text)::INTEGER AS length FROM kept
    """
)
def upsert_latest_wins(spark, folder):
    """The last answer of a conversation replaces its last question."""
    turns = table(spark, folder, "conversations")
    newest = [F.col("turn").desc()]
    asked = records.latest(turns.where(F.col("role") != "assistant"), newest, "conv_id")
    answered = records.latest(turns.where(F.col("role") == "assistant"), newest, "conv_id")
    return records.upsert(asked, answered, "conv_id").select(
        "conv_id", "turn", "role", F.length("text").alias("length")
    )


@register("SELECT doc_id, doc_id IN (SELECT doc_id FROM labels) AS was_update FROM documents")
def store_flags(spark, folder):
    labels = table(spark, folder, "labels")
    return records.existing_flags(_documents(spark, folder).select("doc_id"), labels, id_col="doc_id")


@register("SELECT doc_id, doc_id IN (SELECT doc_id FROM labels WHERE quality = 0) AS found FROM documents")
def delete_flags(spark, folder):
    existing = table(spark, folder, "labels").where(F.col("quality") == 0)
    return records.existing_flags(_documents(spark, folder).select("doc_id"), existing, "found", "doc_id")


@register(
    """
    SELECT vec_id, CASE
      WHEN label = 0 THEN 'id_blank' WHEN label = 1 THEN 'vector_empty' WHEN label IN (2, 3) THEN 'vector_not_finite'
      WHEN label = 4 THEN 'dimension_mismatch' ELSE 'ok' END AS reason FROM embeddings
    """
)
def validate_records(spark, folder):
    """Records with faults put in, by label: id, no elements, NaN, infinity, dimension."""
    label = F.col("label")
    head = F.slice("embedding", 1, 63)
    put = lambda x: F.concat(head, F.array(F.lit(x).cast("float")))
    vector = (
        F.when(label == 1, F.slice("embedding", 1, 0))
        .when(label == 2, put(float("nan")))
        .when(label == 3, put(float("-inf")))
        .when(label == 4, head)
        .otherwise(F.col("embedding"))
    )
    id_ = F.when(label == 0, F.lit(" \t ")).otherwise(F.col("vec_id").cast("string"))
    made = table(spark, folder, "embeddings").select("vec_id", id_.alias("id"), vector.alias("vector"))
    valid, rejects = quality.split_valid(made, quality.record_reason(dim=64))
    return valid.select("vec_id", F.lit("ok").alias("reason")).unionByName(
        rejects.select("vec_id", F.col(quality.REASON).alias("reason"))
    )


@register(
    """
    SELECT doc_id, CASE
      WHEN source = 'src0' THEN 'id_too_long' WHEN source = 'src1' THEN 'id_blank' WHEN source = 'src2' THEN 'text_blank'
      WHEN source = 'src3' AND length(text) * 50 > 1000000 THEN 'text_too_long'
      WHEN source = 'src4' AND length(text) * 100 + 11 + 10 * (length(text) - length(replace(text, chr(10), ''))) * 10
           > 100000 THEN 'payload_too_large'
      ELSE 'ok' END AS reason FROM documents
    """
)
def validate_texts(spark, folder):
    """Texts with faults put in, by source: long id, blank id, blank text, long text, large payload."""
    source = F.col("source")
    id_ = (
        F.when(source == "src0", F.repeat(F.lit("i"), 513))
        .when(source == "src1", F.lit("  "))
        .otherwise(F.col("doc_id").cast("string"))
    )
    text = (
        F.when(source == "src2", F.lit(" \n　 "))
        .when(source == "src3", F.repeat("text", 50))
        .otherwise(F.col("text"))
    )
    note = F.when(source == "src4", F.repeat(F.col("text"), 100)).otherwise(F.lit(""))
    made = _documents(spark, folder).select(
        "doc_id", id_.alias("id"), text.alias("text"), F.struct(note.alias("note")).alias("given")
    )
    reason = quality.store_reason(
        F.col("id"),
        F.col("text"),
        F.col("given"),
        max_id=quality.MAX_ID_LENGTH,
        max_text=quality.MAX_STORE_LENGTH,
        max_payload=quality.MAX_PAYLOAD_LENGTH,
    )
    return made.select("doc_id", F.coalesce(reason, F.lit("ok")).alias("reason"))


@register(
    """
    SELECT event_id, CASE WHEN event_type = 'error' THEN 'payload_not_an_object'
                          WHEN event_type = 'view' THEN 'vector_not_finite' ELSE 'ok' END AS reason FROM events
    """
)
def validate_documents(spark, folder):
    """Whole documents: a payload that is a list, and a vector that is not finite."""
    kind = F.col("event_type")
    payload = F.parse_json(F.when(kind == "error", F.concat(F.lit("["), "props", F.lit("]"))).otherwise(F.col("props")))
    last = F.when(kind == "view", F.lit(float("inf"))).otherwise(F.col("value"))
    made = table(spark, folder, "events").select(
        "event_id", F.col("event_id").alias("id"), F.array(F.lit(1.0), last).alias("vector"), payload.alias("payload")
    )
    reason = quality.document_reason(F.col("payload"))
    return made.select("event_id", F.coalesce(reason, F.lit("ok")).alias("reason"))


def _new_collection(spark, name: str, dim: int, **options) -> Collection:
    return Collection.create(spark, f"{name}_{uuid.uuid4().hex}", dim, **options)


@register(
    """
    SELECT label, label % 2 = 0 AS before, false AS after, count(*) FILTER (label % 2 = 0) AS records
    FROM embeddings GROUP BY label
    """
)
def collection_drop(spark, folder):
    """A collection for every second label: which exist, what they hold, and that none is left after dropping."""
    given = table(spark, folder, "embeddings")
    rows = []
    for (label,) in given.select("label").distinct().orderBy("label").collect():
        name = f"dropped_{label}_{uuid.uuid4().hex}"
        records_in = 0
        if label % 2 == 0:
            coll = Collection.create(spark, name, 64)
            own = given.where(F.col("label") == label)
            coll.upsert(own.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector")))
            records_in = coll.count()
        before = Collection.exists(spark, name)
        if before:
            Collection.drop(spark, name)
        rows.append((label, before, Collection.exists(spark, name), records_in))
    return spark.createDataFrame(rows, "label int, before boolean, after boolean, records long")


@register(
    f"""
    WITH {hashed(32)}, newest AS (SELECT doc_id::VARCHAR AS id, lang, v FROM vec JOIN documents USING (doc_id))
    SELECT id, lang, round(list_sum(v), 6) AS total FROM newest
    """
)
def store_texts(spark, folder):
    """Plain texts embedded and upserted; of two versions of a document in one batch the later one stays."""
    docs = _documents(spark, folder)
    coll = _new_collection(spark, "texts", 32, payload="lang string")
    older = docs.withColumn("text", F.lit("an older version")).withColumn("version", F.lit(1))
    both = docs.withColumn("version", F.lit(2)).unionByName(older)
    provider = HashingProvider.fit(docs, dim=32)
    coll.store_texts(both, provider, id_col="doc_id", payload=["lang"], order_by=[F.col("version")], strict=False)
    total = F.aggregate("vector", F.lit(0.0), lambda acc, x: acc + x)
    return coll.read().select("id", "lang", F.round(total, 6).alias("total"))


@register(
    """
    WITH e AS (SELECT vec_id::VARCHAR AS id, label, 'first' AS stage, embedding::DOUBLE[] AS v FROM embeddings
               WHERE label <> 3 AND vec_id::VARCHAR NOT IN (SELECT doc_id::VARCHAR FROM labels WHERE toxic = 1)),
    c AS (SELECT id, CASE WHEN label >= 5 THEN 'second' WHEN label = 2 THEN 'changed' ELSE stage END AS stage,
                 label, CASE WHEN label >= 5 THEN list_transform(v, lambda x: -x) ELSE v END AS v FROM e)
    SELECT id, label, stage, round(list_sum(v), 5) AS total FROM c
    """
)
def collection_lifecycle(spark, folder):
    """Create, upsert twice, update, delete by filter and by ids, rewrite the base, read."""
    coll = _new_collection(spark, "lifecycle", 64, payload="label int, stage string")
    rows = table(spark, folder, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label", F.lit("first").alias("stage")
    )
    coll.upsert(rows)
    turned = F.transform(F.col("vector").cast("array<double>"), lambda x: -x)
    coll.upsert(rows.where(F.col("label") >= 5).withColumn("vector", turned).withColumn("stage", F.lit("second")))
    coll.update_where({"label": 2}, {"stage": "changed"})
    coll.delete_where({"label": 3})
    coll.delete(_toxic_ids(spark, folder))
    coll.compact()
    total = F.aggregate("vector", F.lit(0.0), lambda acc, x: acc + x)
    return coll.read().select("id", "label", "stage", F.round(total, 5).alias("total"))


@register(
    """
    WITH q AS (SELECT embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id = 0)
    SELECT vec_id::VARCHAR AS id, label, round(list_cosine_similarity(embedding::DOUBLE[], q.v), 6) AS score
    FROM embeddings, q WHERE label <> 4
    ORDER BY list_cosine_similarity(embedding::DOUBLE[], q.v) DESC, id LIMIT 10
    """
)
def collection_search(spark, folder):
    """Search in a collection that has changes beside its base."""
    coll = _new_collection(spark, "searched", 64, payload="label int")
    given = table(spark, folder, "embeddings")
    coll.upsert(given.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label"))
    coll.delete_where({"label": 4})
    found = coll.search(given.where(F.col("vec_id") == 0).select("embedding"), 10)
    return found.select("id", "label", F.round("score", 6).alias("score"))


@register(
    r"""
    SELECT doc_id::VARCHAR AS id, 16 AS vector_dimensions, lang <> 'en' AS was_update, length(text)::INTEGER AS text_length,
           'lang,source,text,_stored_at,_text_length,_word_count,_analysis' AS payload_keys
    FROM documents WHERE regexp_matches(text, '[\p{L}\p{N}]')
    """
)
def store_pipeline(spark, folder):
    """Check, enrich, embed and upsert all documents into a collection that has some of them already."""
    docs = _documents(spark, folder)
    coll = _new_collection(spark, "stored", 16, payload="lang string, source string, text string")
    provider = HashingProvider.fit(docs, dim=16)
    names = {"id_col": "doc_id", "payload": ["lang", "source"]}
    coll.store_memories(docs.where(F.col("lang") != "en"), provider, strict=False, **names)
    report, _ = coll.store_memories(docs, provider, strict=False, **names)
    return report.withColumn("payload_keys", F.array_join("payload_keys", ","))


@register(
    f"""
    WITH {hashed(16)}
    SELECT doc_id::VARCHAR AS id, lang, length(text)::INTEGER AS text_length, round(list_sum(v), 6) AS total
    FROM vec JOIN documents USING (doc_id)
    """
)
def stream_store(spark, folder):
    """The documents as a stream of files, stored in a collection micro-batch by micro-batch."""
    known = _documents(spark, folder)
    coll = _new_collection(spark, "streamed", 16, payload="lang string, _text_length int")
    docs = ingest.text_stream(spark, f"{folder}/documents.parquet", known.schema)
    checkpoint = workspace.new_path(spark, "stream")
    provider = HashingProvider.fit(known, dim=16)
    query = ingest.store_stream(
        docs, coll, provider, checkpoint=checkpoint, id_col="doc_id", payload=["lang", "source"], order_by=[F.col("n_chars")]
    )
    query.awaitTermination()
    total = F.aggregate("vector", F.lit(0.0), lambda acc, x: acc + x)
    return coll.read().select("id", "lang", F.col("_text_length").alias("text_length"), F.round(total, 6).alias("total"))


@register("SELECT count(*) AS count FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND lang <> 'fr'")
def count_after_delete(spark, folder):
    docs = _documents(spark, folder).select("doc_id", "lang")
    left = records.delete_by_ids(docs, table(spark, folder, "labels").select("doc_id"), "doc_id")
    return counts.count_records(left, filters.none_of({"lang": "fr"}))


def _load_lengths():
    """A stand-in for a model: the length of a text and its spaces."""
    return lambda texts: [[float(len(t)), 1.0 + t.count(" ")] for t in texts]


@register(
    """
    SELECT conv_id::VARCHAR AS id, turn, length(text)::DOUBLE AS first_element FROM conversations
    QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1
    """
)
def stream_out_of_order(spark, folder):
    """Turns of conversations that arrive latest first, in several micro-batches: the last turn stays."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "text")
    arriving = workspace.new_path(spark, "turns")
    for rest in (2, 1, 0):
        turns.where(F.col("turn") % 3 == rest).write.mode("append").parquet(arriving)
    coll = _new_collection(spark, "turns", 2, payload="turn long", version="turn")
    docs = ingest.text_stream(spark, arriving, turns.schema, files_per_batch=1)
    query = ingest.store_stream(
        docs, coll, PythonProvider(_load_lengths), checkpoint=workspace.new_path(spark, "stream"), id_col="conv_id", payload=["turn"],
        rejects=workspace.new_path(spark, "rejects"),
    )
    query.awaitTermination()
    return coll.read().select("id", "turn", F.element_at("vector", 1).alias("first_element"))


@register(
    """
    SELECT doc_id, length(text)::DOUBLE AS first_element, (1 + length(text) - length(replace(text, ' ', '')))::DOUBLE AS second
    FROM documents WHERE regexp_matches(text, '\\S')
    """
)
def embed_once_over_batches(spark, folder):
    """The documents in two batches that overlap; the second one finds the vectors of the first."""
    docs = _documents(spark, folder).select("doc_id", "text")
    store, provider = workspace.new_path(spark, "vectors"), PythonProvider(_load_lengths)
    embed_once(docs.where(F.col("doc_id") % 2 == 0), provider, store)
    made = embed_once(docs, provider, store).where(F.col("error").isNull())
    return made.select("doc_id", F.element_at("vector", 1).alias("first_element"), F.element_at("vector", 2).alias("second"))


def _stored_embeddings(spark, folder, name: str) -> Collection:
    coll = _new_collection(spark, name, 64, payload="label int")
    coll.upsert(table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label"))
    return coll


@register(
    """
    SELECT vec_id::VARCHAR AS id, label FROM embeddings WHERE vec_id::VARCHAR > '2' AND label <> 3 ORDER BY vec_id::VARCHAR LIMIT 60
    """
)
def collection_scroll(spark, folder):
    """Three pages of a rewritten collection, one after the other, with deletions since."""
    coll = _stored_embeddings(spark, folder, "paged")
    coll.compact()
    coll.delete_where({"label": 3})
    offset, pages = "2", None
    for _ in range(3):
        page = coll.scroll(limit=20, offset=offset).select("id", "label")
        pages = page if pages is None else pages.unionByName(page)
        # the last id of a page is where the next one begins
        offset = page.agg(F.max("id")).first()[0] or offset
    return pages


@register(
    """
    WITH s AS (
      SELECT q.vec_id AS query_id, e.vec_id::VARCHAR AS id, e.label, list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS raw
      FROM embeddings q CROSS JOIN embeddings e WHERE e.label <> 4),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY raw DESC, id) AS n FROM s)
    SELECT query_id, id, round(raw, 6) AS score, n::INTEGER AS rank, label FROM r WHERE n <= 3
    """
)
def collection_cells(spark, folder):
    """A collection with cells, changed since: every record's three nearest, by cells that bounds cannot rule out."""
    rows = table(spark, folder, "embeddings")
    coll = _stored_embeddings(spark, folder, "celled")
    coll.index_cells()
    again = rows.where(F.col("label") >= 5).select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label")
    coll.upsert(again)
    coll.delete_where({"label": 4})
    queries = rows.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    found = coll.search_batch(queries, 3, prune=True, payload=["label"])
    return found.withColumn("score", F.round("score", 6))
