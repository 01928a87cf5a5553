"""Text measures, enrichment, embedding, cost, and search by text."""

from __future__ import annotations

from pyspark.sql import functions as F

from semstore.functions import models
from semstore.functions import text as measures
from semstore.operators import counts, embed, knn, search, store
from semstore.plans import sizing
from semstore.plans.workload.registry import register, table

# ECMAScript white space as a regex class for RE2.
_WS = r"[\t\n\x0B\f\r \x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{FEFF}]"
_NON_WS = "[^" + _WS[1:]
_TRIMMED = f"regexp_replace(text, '^{_WS}+|{_WS}+$', '', 'g')"
_WORDS = f"len(list_filter(string_split_regex({_TRIMMED}, '{_WS}+'), lambda w: w <> ''))::INTEGER"
_ENGLISH = "|".join(measures.ENGLISH_WORDS)


def _documents(spark, folder):
    return table(spark, folder, "documents")


def _texts(spark, folder):
    """The documents, dealt out to all cores for work on every character."""
    return sizing.spread(_documents(spark, folder))


@register(f"SELECT doc_id, length(text)::INTEGER AS length, {_WORDS} AS words FROM documents")
def word_count(spark, folder):
    text = F.col("text")
    return _texts(spark, folder).select(
        "doc_id", measures.utf16_length(text).alias("length"), measures.word_count(text).alias("words")
    )


@register(
    f"""
    SELECT doc_id, regexp_matches(lower(text), '(^|[^A-Za-z0-9_])({_ENGLISH})($|[^A-Za-z0-9_])') AS likely_english,
           regexp_matches(text, '[.,;:!?]') AS has_punctuation, regexp_matches(text, '[A-Z]') AS has_capitalization
    FROM documents
    """
)
def language_hints(spark, folder):
    return _texts(spark, folder).select("doc_id", measures.language_hints(F.col("text")).alias("h")).select(
        "doc_id", "h.*"
    )


@register(
    f"""
    SELECT doc_id, greatest({_WORDS}, 1) AS word_count, length(text)::INTEGER AS character_count,
           len(string_split(text, chr(10)))::INTEGER AS line_count,
           len(list_filter(string_split_regex(text, '[.!?]+'),
               lambda s: regexp_matches(s, '{_NON_WS}')))::INTEGER
             AS sentence_count,
           round(length(text) / greatest({_WORDS}, 1)::DOUBLE, 6) AS avg_word_length,
           regexp_matches(text, 'https?://') AS contains_urls, regexp_matches(text, '@\\w+\\.\\w+') AS contains_emails,
           regexp_matches(text, '\\d') AS contains_numbers
    FROM documents
    """
)
def text_analysis(spark, folder):
    found = _texts(spark, folder).select("doc_id", measures.analysis(F.col("text")).alias("a"))
    return found.select("doc_id", "a.*").drop("language_hints").withColumn(
        "avg_word_length", F.round("avg_word_length", 6)
    )


@register(
    f"""
    SELECT doc_id, CASE WHEN lang = 'en' THEN '' WHEN lang = 'de' THEN 'own' ELSE md5(text) END AS kept_text,
           length(text)::INTEGER AS text_length, {_WORDS} AS words, '2026-01-01T00:00:00Z' AS stored_at
    FROM documents
    """
)
def stored_payload(spark, folder):
    """The text is kept where the payload has neither a text nor a content of its own."""
    lang = F.col("lang")
    docs = _texts(spark, folder).select(
        "doc_id",
        "lang",
        F.col("text").alias("source_text"),
        F.when(lang == "de", "own").otherwise("").alias("text"),
        F.when(lang == "en", "given").alias("content"),
    )
    clock = F.lit("2026-01-01T00:00:00Z")
    made = store.enrich(docs, text_col="source_text", payload=["text", "content"], stored_at=clock)
    kept = F.when(lang.isin("de", "en"), F.col("text")).otherwise(F.md5("text"))
    return made.select(
        "doc_id",
        kept.alias("kept_text"),
        F.col("_text_length").alias("text_length"),
        F.col("_word_count").alias("words"),
        F.col("_stored_at").alias("stored_at"),
    )


_CATALOG = "(VALUES " + ", ".join(
    f"('{m}', {d}, {t}, {'NULL' if s is None else s}, {'NULL' if p is None else f'{p:.5f}'}::DOUBLE)"
    for m, d, t, s, p in models.MODELS
) + ") AS m(model, dimensions, max_tokens, supports_dimensions, price_per_1k)"
_MODEL_OF = """CASE lang WHEN 'en' THEN 'text-embedding-3-small' WHEN 'fr' THEN 'text-embedding-3-large'
               WHEN 'de' THEN 'nomic-embed-text' ELSE 'unheard-of' END"""


def _model_of(lang):
    return (
        F.when(lang == "en", "text-embedding-3-small")
        .when(lang == "fr", "text-embedding-3-large")
        .when(lang == "de", "nomic-embed-text")
        .otherwise("unheard-of")
    )


@register(
    f"""
    WITH d AS (SELECT doc_id, {_MODEL_OF} AS model, length(text) AS n FROM documents)
    SELECT doc_id, d.model, ceil(n / 4)::BIGINT AS tokens,
           coalesce(round(ceil(n / 4) / 1000 * price_per_1k, 9), -1) AS cost,
           coalesce(ceil(n / 4) > max_tokens, false) AS over_limit
    FROM d LEFT JOIN {_CATALOG} ON m.model = d.model
    """
)
def embedding_cost(spark, folder):
    """Tokens and price of every document, for a model chosen by its language; unknown prices give -1."""
    docs = _documents(spark, folder).select("doc_id", "lang", measures.utf16_length(F.col("text")).alias("n"))
    priced = models.with_model(docs, _model_of(F.col("lang")))
    tokens = models.estimated_tokens(F.col("n"))
    cost = models.estimated_cost(F.col("n"), F.col("price_per_1k"))
    return priced.select(
        "doc_id",
        "model",
        tokens.alias("tokens"),
        F.coalesce(F.round(cost, 9), F.lit(-1.0)).alias("cost"),
        F.coalesce(tokens > F.col("max_tokens"), F.lit(False)).alias("over_limit"),
    )


@register(
    f"""
    SELECT model, count(*) AS documents, sum(ceil(length(text) / 4))::BIGINT AS tokens,
           round(sum(ceil(length(text) / 4) / 1000 * price_per_1k), 6) AS cost
    FROM documents CROSS JOIN {_CATALOG} WHERE price_per_1k IS NOT NULL GROUP BY model
    """
)
def corpus_cost(spark, folder):
    """What embedding the corpus costs with each priced model; the prices apply to the totals, not to pairs."""
    totals = _documents(spark, folder).agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum(models.estimated_tokens(measures.utf16_length(F.col("text")))).alias("tokens"),
    )
    priced = [(m, p) for m, _, _, _, p in models.MODELS if p is not None]
    offers = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.lit(p).alias("price")) for m, p in priced]))
    return totals.select("documents", "tokens", offers.alias("o")).select(
        "o.model", "documents", "tokens", F.round(F.col("tokens") / 1000 * F.col("o.price"), 6).alias("cost")
    )


@register(
    f"""
    WITH e AS (SELECT vec_id, len(embedding)::INTEGER AS found, CASE WHEN label < 3 THEN 'all-minilm'
               WHEN label < 6 THEN 'mxbai-embed-large' ELSE 'unheard-of' END AS model FROM embeddings)
    SELECT vec_id, e.model, found, coalesce(dimensions, 0) AS expected,
           coalesce(dimensions = found, false) AS fits FROM e LEFT JOIN {_CATALOG} ON m.model = e.model
    """
)
def model_dims(spark, folder):
    """The dimension each record's model should give, beside the one it has."""
    label = F.col("label")
    model = F.when(label < 3, "all-minilm").when(label < 6, "mxbai-embed-large").otherwise("unheard-of")
    sized = table(spark, folder, "embeddings").select("vec_id", "label", F.size("embedding").alias("found"))
    return models.with_model(sized, model).select(
        "vec_id",
        "model",
        "found",
        F.coalesce("dimensions", F.lit(0)).alias("expected"),
        F.coalesce(F.col("dimensions") == F.col("found"), F.lit(False)).alias("fits"),
    )


def hashed(dim: int, **asked: str) -> str:
    """Common table expressions: `vec` (doc_id, v) of all documents, and one like it for each query that is asked.

    `asked` gives for each name a query of ids and texts, whose vectors use the documents' weights.
    """
    place = f"('0x' || substr(md5(w), 1, 8))::BIGINT % {dim}"

    def vectors(name: str, source: str, id_: str) -> str:
        return f"""
        {name}_tok AS (SELECT {id_}, {place} AS b, count(*) AS c FROM
          (SELECT {id_}, unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+')) AS w FROM ({source})) GROUP BY ALL),
        {name}_raw AS (SELECT {id_}, list(coalesce(c, 0) * coalesce(f, (SELECT ln(count(*) + 1) FROM documents)) ORDER BY b) AS raw
          FROM (SELECT {id_}, b FROM (SELECT DISTINCT {id_} FROM {name}_tok) CROSS JOIN range({dim}) r(b))
          LEFT JOIN {name}_tok USING ({id_}, b) LEFT JOIN idf USING (b) GROUP BY {id_}),
        {name} AS (SELECT {id_}, list_transform(raw, lambda x: x / sqrt(list_dot_product(raw, raw))) AS v FROM {name}_raw
          WHERE list_dot_product(raw, raw) > 0)"""

    made = vectors("vec", "SELECT doc_id, text FROM documents", "doc_id")
    first, rest = made.split("vec_raw AS", 1)
    idf = "idf AS (SELECT b, ln(((SELECT count(*) FROM documents) + 1) / (count(*) + 1)) AS f FROM vec_tok GROUP BY b)"
    others = [vectors(name, source, "query_id") for name, source in asked.items()]
    return ",".join([first.rstrip().rstrip(","), idf, f"vec_raw AS{rest}", *others])


@register(
    f"""
    WITH {hashed(128)}
    SELECT doc_id, round(list_sum(v), 6) AS total, round(v[1], 6) AS first_element, round(list_max(v), 6) AS largest FROM vec
    """
)
def embed_hashing(spark, folder):
    """Hashed bags of all words, weighted over the whole corpus."""
    docs = _documents(spark, folder)
    made = embed.embed(docs, embed.HashingProvider.fit(docs, dim=128)).where(F.col("error").isNull())
    total = F.aggregate("vector", F.lit(0.0), lambda acc, x: acc + x)
    return made.select(
        "doc_id",
        F.round(total, 6).alias("total"),
        F.round(F.element_at("vector", 1), 6).alias("first_element"),
        F.round(F.array_max("vector"), 6).alias("largest"),
    )


def _load_counter():
    """A stand-in for a model: counts characters, spaces and stops, and refuses texts with an at sign."""

    def count(texts):
        if any("@" in t for t in texts):
            raise ValueError("unsupported character")
        return [[float(len(t)), float(t.count(" ")), float(t.count("."))] for t in texts]

    return count


_COUNTED = """
SELECT doc_id, CASE WHEN NOT regexp_matches(text, '\\S') THEN 'text_blank'
                    WHEN contains(text, '@') THEN 'unsupported character' ELSE 'ok' END AS outcome,
       CASE WHEN contains(text, '@') OR NOT regexp_matches(text, '\\S') THEN -1.0::DOUBLE
            ELSE (length(text) + 10 * (length(text) - length(replace(text, ' ', '')))
                  + 100 * (length(text) - length(replace(text, '.', ''))))::DOUBLE END AS total
FROM documents
"""


@register(_COUNTED)
def embed_udf(spark, folder):
    """A Python model over all documents; a text it refuses does not fail the others."""
    made = embed.embed(_documents(spark, folder), embed.PythonProvider(_load_counter, batch_size=32))
    v = F.col("vector")
    total = v[0] + 10 * v[1] + 100 * v[2]
    return made.select(
        "doc_id", F.coalesce("error", F.lit("ok")).alias("outcome"), F.coalesce(total, F.lit(-1.0)).alias("total")
    )


@register(
    f"""
    WITH o AS (SELECT outcome FROM ({_COUNTED}))
    SELECT count(*) FILTER (outcome = 'ok') AS success_count, count(*) FILTER (outcome <> 'ok') AS failure_count FROM o
    """
)
def embed_totals(spark, folder):
    made = embed.embed(_documents(spark, folder), embed.PythonProvider(_load_counter, batch_size=32))
    return counts.embedding_totals(made)


_TEXT_QUERY = "the art of the and in that word with a la der"
_ASKED = f"SELECT 0 AS query_id, '{_TEXT_QUERY}' AS text"


@register(
    f"""
    WITH {hashed(64, q=_ASKED)},
    d AS (SELECT doc_id, lang, vec.v, q.v AS qv FROM vec JOIN documents USING (doc_id), q WHERE lang = 'en')
    SELECT doc_id, lang, round(list_cosine_similarity(v, qv), 6) AS score FROM d
    ORDER BY list_cosine_similarity(v, qv) DESC, doc_id LIMIT 10
    """
)
def search_text(spark, folder):
    docs = _documents(spark, folder)
    provider = embed.HashingProvider.fit(docs, dim=64)
    coll = embed.embed(docs, provider).where(F.col("error").isNull()).select("doc_id", "lang", "vector")
    found = search.search_text(coll, f"  {_TEXT_QUERY}\n", provider, where={"lang": "en"}, id_col="doc_id")
    return found.withColumn("score", F.round("score", 6))


@register(
    f"""
    WITH {hashed(64, q=_ASKED)}, d AS (SELECT doc_id, text, lang, vec.v, q.v AS qv FROM vec JOIN documents USING (doc_id), q)
    SELECT doc_id, round(list_cosine_similarity(v, qv), 6) AS score, md5({_TRIMMED}) AS text, lang,
           5::BIGINT AS total_results, false AS has_filter FROM d
    ORDER BY list_cosine_similarity(v, qv) DESC, doc_id LIMIT 5
    """
)
def search_memory(spark, folder):
    """Text search with the result text, the number of results and whether a filter was given."""
    docs = _documents(spark, folder)
    provider = embed.HashingProvider.fit(docs, dim=64)
    coll = embed.embed(docs, provider).where(F.col("error").isNull()).drop("error")
    found = search.search_memory(coll, _TEXT_QUERY, provider, id_col="doc_id")
    return found.select(
        "doc_id",
        F.round("score", 6).alias("score"),
        F.md5("text").alias("text"),
        F.col("payload.lang").alias("lang"),
        "total_results",
        "has_filter",
    )


@register(
    f"""
    WITH {hashed(64, q="SELECT item_id AS query_id, text FROM benchmark")},
    s AS (SELECT query_id, doc_id, list_cosine_similarity(vec.v, q.v) AS raw FROM q CROSS JOIN vec),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY raw DESC, doc_id) AS n FROM s)
    SELECT query_id, doc_id, round(raw, 6) AS score, n::INTEGER AS rank FROM r WHERE n <= 5
    """
)
def search_texts_batch(spark, folder):
    """Every benchmark text as a query over all documents."""
    docs = _documents(spark, folder)
    provider = embed.HashingProvider.fit(docs, dim=64)
    coll = embed.embed(docs, provider).where(F.col("error").isNull())
    asked = embed.embed(table(spark, folder, "benchmark"), provider).where(F.col("error").isNull())
    queries = asked.select(F.col("item_id").alias("query_id"), "vector")
    found = knn.search_batch(coll, queries, 5, id_col="doc_id")
    return found.withColumn("score", F.round("score", 6))


@register(
    f"""
    SELECT page_id, md5(regexp_replace(CASE WHEN length(html) > 3000 THEN html ELSE url END,
                                       '^{_WS}+|{_WS}+$', '', 'g')) AS text FROM pages
    """
)
def result_text(spark, folder):
    """The first non-blank text among the known fields; numbers and blanks are passed over."""
    pages = table(spark, folder, "pages").select(
        "page_id",
        F.length("html").alias("text"),
        F.lit("  \n").alias("content"),
        F.when(F.length("html") > 3000, F.col("html")).alias("description"),
        F.concat(F.lit("\t"), "url", F.lit("  ")).alias("title"),
    )
    return pages.select("page_id", F.md5(search.result_text(pages)).alias("text"))
