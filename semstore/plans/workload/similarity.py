"""Vectors, search, recommendation, quantised and approximate search, on the ``embeddings`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from semstore.functions import vectors
from semstore.operators import approx, cells, counts, knn, pairs, quantize, recommend, search, similarity_join
from semstore.plans import workspace
from semstore.plans.workload.registry import register, table

NAMES = {"id_col": "vec_id", "vector_col": "embedding"}
QUANTILE = 0.99
TAIL = (1 - QUANTILE) / 2


def _embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings")


def _query(coll: DataFrame) -> DataFrame:
    return coll.where(F.col("vec_id") == 0).select("embedding")


def _queries(coll: DataFrame) -> DataFrame:
    return coll.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"), "label")


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("score", F.round("score", 6))


_ONE = """
WITH q AS (SELECT embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id = 0),
s AS (SELECT vec_id, label, {score}(embedding::DOUBLE[], q.v) AS raw FROM embeddings, q)
SELECT vec_id, label, round(raw, 6) AS score FROM s {where} ORDER BY raw {order}, vec_id {limit}
"""
COSINE, DOT, DISTANCE = "list_cosine_similarity", "list_inner_product", "list_distance"


@register(_ONE.format(score=COSINE, where="", order="DESC", limit="LIMIT 10"))
def search_cosine_topk(spark, folder):
    coll = _embeddings(spark, folder)
    return _rounded(search.search(coll, _query(coll), 10, **NAMES))


@register(_ONE.format(score=COSINE, where="WHERE label = 1", order="DESC", limit="LIMIT 10"))
def search_filtered_topk(spark, folder):
    coll = _embeddings(spark, folder)
    return _rounded(search.search(coll, _query(coll), 10, where={"match": {"key": "label", "value": 1}}, **NAMES))


@register(_ONE.format(score=DOT, where="", order="DESC", limit="LIMIT 10"))
def search_dot(spark, folder):
    """With top_k 0, which means the default of 10."""
    coll = _embeddings(spark, folder)
    return _rounded(search.search(coll, _query(coll), 0, metric="Dot", **NAMES))


@register(_ONE.format(score=DISTANCE, where="", order="ASC", limit="LIMIT 10"))
def search_euclidean(spark, folder):
    coll = _embeddings(spark, folder)
    return _rounded(search.search(coll, _query(coll), 10, metric="Euclidean", **NAMES))


@register(
    """
    WITH q AS (SELECT embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id = 0),
    s AS (SELECT vec_id, list_cosine_similarity(embedding::DOUBLE[], q.v) AS raw FROM embeddings, q
          ORDER BY raw DESC, vec_id LIMIT 100)
    SELECT vec_id, round(raw, 6) AS score FROM s WHERE raw >= 0.2
    """
)
def search_threshold(spark, folder):
    coll = _embeddings(spark, folder)
    found = search.search(coll, _query(coll), 100, score_threshold=0.2, with_payload=False, **NAMES)
    return _rounded(found)


@register(
    """
    WITH q AS (SELECT embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id = 0),
    s AS (SELECT vec_id, embedding::DOUBLE[] AS e, list_cosine_similarity(embedding::DOUBLE[], q.v) AS raw
          FROM embeddings, q WHERE label IN (2, 3) ORDER BY raw DESC, vec_id LIMIT 20)
    SELECT vec_id, round(raw, 6) AS score, round(list_sum(e), 5) AS vector_sum FROM s
    """
)
def search_with_vector(spark, folder):
    coll = _embeddings(spark, folder)
    found = search.search(
        coll, _query(coll), 20, where={"label": [2, 3]}, with_vector=True, with_payload=False, **NAMES
    )
    total = F.aggregate(vectors.as_double(F.col("embedding")), F.lit(0.0), lambda acc, x: acc + x)
    return _rounded(found).select("vec_id", "score", F.round(total, 5).alias("vector_sum"))


@register(_ONE.format(score=COSINE, where="", order="DESC", limit=""))
def rank_all_by_similarity(spark, folder):
    coll = _embeddings(spark, folder)
    return _rounded(search.rank_all(coll, _query(coll), **NAMES))


_BATCH = """
WITH s AS (
  SELECT q.vec_id AS query_id, e.vec_id, {score}(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS raw
  FROM embeddings q CROSS JOIN embeddings e {where}),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY raw {order}, vec_id) AS n FROM s)
SELECT query_id, vec_id, round(raw, 6) AS score, n::INTEGER AS rank FROM r WHERE n <= 5 {threshold}
"""


@register(_BATCH.format(score=COSINE, where="", order="DESC", threshold=""))
def search_batch_topk(spark, folder):
    """The five nearest records to every record."""
    coll = _embeddings(spark, folder)
    return _rounded(knn.search_batch(coll, _queries(coll), 5, **NAMES))


@register(_BATCH.format(score=DISTANCE, where="", order="ASC", threshold=""))
def search_batch_euclidean(spark, folder):
    coll = _embeddings(spark, folder)
    return _rounded(knn.search_batch(coll, _queries(coll), 5, metric="euclidean", **NAMES))


@register(_BATCH.format(score=DOT, where="WHERE e.label >= 5", order="DESC", threshold="AND raw >= 0.3"))
def search_batch_filtered_threshold(spark, folder):
    coll = _embeddings(spark, folder)
    found = knn.search_batch(
        coll, _queries(coll), 5, where={"label": {"gte": 5}}, metric="dot", score_threshold=0.3, **NAMES
    )
    return _rounded(found)


@register(
    """
    WITH s AS (
      SELECT q.vec_id AS query_id, q.label AS q_label, e.vec_id,
             list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS raw
      FROM embeddings q CROSS JOIN embeddings e
      WHERE CASE WHEN q.label < 4 THEN e.label = 1 WHEN q.label < 8 THEN e.label <> 1 ELSE true END),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY raw DESC, vec_id) AS n FROM s)
    SELECT query_id, vec_id, round(raw, 6) AS score, n::INTEGER AS rank FROM r
    WHERE n <= CASE WHEN q_label = 0 THEN 10 ELSE q_label END
    """
)
def search_batch_own_filters(spark, folder):
    """Every query with a filter and a number of results of its own."""
    coll = _embeddings(spark, folder)
    name = F.when(F.col("label") < 4, "ones").when(F.col("label") < 8, "others")
    queries = _queries(coll).select("query_id", "vector", F.col("label").alias("top_k"), name.alias("filter_name"))
    filters = {"ones": {"label": 1}, "others": {"must_not": [{"label": 1}]}}
    return _rounded(knn.search_batch(coll, queries, filters=filters, **NAMES))


@register(
    """
    WITH s AS (
      SELECT q.vec_id AS query_id, e.vec_id, e.label,
             list_cosine_similarity(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS raw
      FROM embeddings q CROSS JOIN embeddings e),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY raw DESC, vec_id) AS n FROM s)
    SELECT query_id, vec_id, label, round(raw, 6) AS score, n::INTEGER AS rank FROM r WHERE n <= 3
    """
)
def search_batch_with_payload(spark, folder):
    coll = _embeddings(spark, folder)
    return _rounded(knn.search_batch(coll, _queries(coll), 3, payload=["label"], **NAMES))


_MEANS = """
p AS (SELECT list(m ORDER BY i) AS v FROM (SELECT i, avg(e[i]) AS m FROM
      (SELECT embedding::DOUBLE[] AS e FROM embeddings WHERE label = 1), range(1, 65) t(i) GROUP BY i)),
n AS (SELECT list(m ORDER BY i) AS v FROM (SELECT i, avg(e[i]) AS m FROM
      (SELECT embedding::DOUBLE[] AS e FROM embeddings WHERE label = 2), range(1, 65) t(i) GROUP BY i))
"""


@register(
    f"""
    WITH {_MEANS},
    q AS (SELECT list_transform(range(1, 65), lambda i: p.v[i] + (p.v[i] - n.v[i])) AS v FROM p, n)
    SELECT vec_id, label, round(list_cosine_similarity(embedding::DOUBLE[], q.v), 6) AS score
    FROM embeddings, q WHERE label NOT IN (1, 2)
    ORDER BY list_cosine_similarity(embedding::DOUBLE[], q.v) DESC, vec_id LIMIT 10
    """
)
def recommend_pos_neg(spark, folder):
    """Near the records of label 1, away from those of label 2."""
    coll = _embeddings(spark, folder)
    near = coll.where(F.col("label") == 1).select("vec_id")
    away = coll.where(F.col("label") == 2).select("vec_id")
    return _rounded(recommend.recommend(coll, near, away, 10, **NAMES))


@register(
    f"""
    WITH {_MEANS}
    SELECT vec_id, label, round(list_cosine_similarity(embedding::DOUBLE[], p.v), 6) AS score
    FROM embeddings, p WHERE label NOT IN (1) AND label < 7
    ORDER BY list_cosine_similarity(embedding::DOUBLE[], p.v) DESC, vec_id LIMIT 10
    """
)
def recommend_filtered(spark, folder):
    coll = _embeddings(spark, folder)
    near = coll.where(F.col("label") == 1).select("vec_id")
    return _rounded(recommend.recommend(coll, near, top_k=10, where={"label": {"lt": 7}}, **NAMES))


@register(
    """
    SELECT a.vec_id AS id_a, b.vec_id AS id_b,
           round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS score
    FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1
    """
)
def pair_similarity(spark, folder):
    """Every record with the next one."""
    coll = _embeddings(spark, folder)
    asked = coll.select(F.col("vec_id").alias("id_a"), (F.col("vec_id") + 1).alias("id_b"))
    return _rounded(pairs.pair_similarity(asked, coll, **NAMES))


@register(
    """
    WITH v AS (SELECT vec_id, CASE WHEN label = 9 THEN list_transform(embedding, lambda x: 0.0)
                                   ELSE list_transform(embedding, lambda x: x::DOUBLE * (label + 2)) END AS e
               FROM embeddings),
    n AS (SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v),
    u AS (SELECT vec_id, CASE WHEN norm > 0 THEN list_transform(e, lambda x: x / norm) ELSE e END AS e FROM n)
    SELECT vec_id, round(list_sum(e), 6) AS total, round(e[1], 6) AS first_element,
           round(list_sum(list_transform(e, lambda x: x * x)), 6) AS squares FROM u
    """
)
def normalize_vectors(spark, folder):
    """Scaled copies of the vectors, some of them zero, brought to unit length."""
    coll = _embeddings(spark, folder)
    zeros = F.transform("embedding", lambda x: F.lit(0.0))
    scaled = F.transform("embedding", lambda x: x.cast("double") * (F.col("label") + 2))
    made = coll.select("vec_id", F.when(F.col("label") == 9, zeros).otherwise(scaled).alias("e"))
    unit = made.select("vec_id", vectors.normalize(F.col("e")).alias("e"))
    total = lambda f: F.round(F.aggregate("e", F.lit(0.0), lambda acc, x: acc + f(x)), 6)
    return unit.select(
        "vec_id",
        total(lambda x: x).alias("total"),
        F.round(F.element_at("e", 1), 6).alias("first_element"),
        total(lambda x: x * x).alias("squares"),
    )


@register(
    """
    WITH v AS (SELECT vec_id, CASE WHEN label = 9 THEN embedding[1:63] ELSE embedding END AS e FROM embeddings),
    f AS (SELECT len(e) AS d FROM v ORDER BY vec_id LIMIT 1),
    o AS (SELECT vec_id, len(e) AS d FROM v WHERE len(e) <> (SELECT d FROM f) ORDER BY vec_id LIMIT 1)
    SELECT (SELECT count(*) FROM v) AS records, (SELECT d FROM f)::INTEGER AS expected_dim,
           (SELECT min(len(e)) FROM v)::INTEGER AS min_dim, (SELECT max(len(e)) FROM v)::INTEGER AS max_dim,
           (SELECT vec_id FROM o) AS offender_id, (SELECT d FROM o)::INTEGER AS offender_dim
    """
)
def dimension_check(spark, folder):
    """The first vector of another dimension, when those of label 9 lack their last element."""
    shorter = F.when(F.col("label") == 9, F.slice("embedding", 1, 63)).otherwise(F.col("embedding"))
    coll = _embeddings(spark, folder).withColumn("embedding", shorter)
    return counts.dimensions(coll, **NAMES)


@register(
    """
    SELECT 'vectors' AS name, 'green' AS status, 64 AS dim, 'cosine' AS metric, count(*) AS records,
           min(len(embedding))::INTEGER AS min_dim, max(len(embedding))::INTEGER AS max_dim FROM embeddings
    """
)
def describe_collection(spark, folder):
    return counts.describe(_embeddings(spark, folder), "vectors", 64, "cosine", "embedding")


_BOUNDS = f"""
x AS (SELECT unnest(embedding::DOUBLE[]) AS x FROM embeddings),
ends AS (SELECT min(x) AS a, max(x) AS b, count(*) AS n FROM x),
h AS (SELECT least(floor((x - a) / ((b - a) / {quantize.BINS})), {quantize.BINS - 1}) AS bin, count(*) AS c
      FROM x, ends GROUP BY 1),
upto AS (SELECT bin, sum(c) OVER (ORDER BY bin) AS upto FROM h),
bounds AS (SELECT
  min(CASE WHEN upto >= greatest(n * {TAIL!r}::DOUBLE, 1) THEN a + bin * ((b - a) / {quantize.BINS}) END) AS low,
  min(CASE WHEN upto >= n * {1 - TAIL!r}::DOUBLE THEN a + (bin + 1) * ((b - a) / {quantize.BINS}) END) AS high
  FROM upto, ends)
"""
_CODES = """
codes AS (SELECT vec_id, label, embedding::DOUBLE[] AS e, low, high, list_transform(embedding::DOUBLE[], lambda x:
  greatest(0, least(floor((x - low) / (high - low) * 255 + 0.5), 255)) - 128) AS code FROM embeddings, bounds),
near AS (SELECT vec_id, label, e, list_transform(code, lambda c: low + (c + 128) * ((high - low) / 255)) AS d
         FROM codes)
"""


@register(f"WITH {_BOUNDS} SELECT round(low, 6) AS low, round(high, 6) AS high FROM bounds")
def quantization_bounds(spark, folder):
    found = quantize.bounds(_embeddings(spark, folder), QUANTILE, "embedding")
    return found.select(F.round("low", 6).alias("low"), F.round("high", 6).alias("high"))


@register(
    f"""
    WITH {_BOUNDS}, {_CODES}
    SELECT vec_id, list_sum(code)::BIGINT AS total, min(code[1])::BIGINT AS first_code,
           list_min(code)::BIGINT AS smallest, list_max(code)::BIGINT AS largest
    FROM codes GROUP BY ALL
    """
)
def quantized_codes(spark, folder):
    coll = quantize.quantized(_embeddings(spark, folder), quantile=QUANTILE, vector_col="embedding")
    return coll.select(
        "vec_id",
        F.aggregate("code", F.lit(0).cast("bigint"), lambda acc, c: acc + c).alias("total"),
        F.element_at("code", 1).cast("bigint").alias("first_code"),
        F.array_min("code").cast("bigint").alias("smallest"),
        F.array_max("code").cast("bigint").alias("largest"),
    )


@register(
    f"""
    WITH {_BOUNDS}, {_CODES}, q AS (SELECT embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id = 0),
    best AS (SELECT vec_id, label, e FROM near, q ORDER BY list_cosine_similarity(d, q.v) DESC, vec_id LIMIT 30)
    SELECT vec_id, label, round(list_cosine_similarity(e, q.v), 6) AS score FROM best, q
    ORDER BY list_cosine_similarity(e, q.v) DESC, vec_id LIMIT 10
    """
)
def quantized_search(spark, folder):
    """Thirty candidates by their byte codes, the best ten of them by exact scores."""
    plain = _embeddings(spark, folder)
    coll = quantize.quantized(plain, quantile=QUANTILE, vector_col="embedding")
    return _rounded(quantize.quantized_search(coll, _query(plain), 10, oversampling=3.0, **NAMES))


@register(
    f"""
    WITH {_BOUNDS}, {_CODES}, q AS (SELECT embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id = 0)
    SELECT vec_id, label, round(list_cosine_similarity(d, q.v), 6) AS score FROM near, q
    ORDER BY list_cosine_similarity(d, q.v) DESC, vec_id LIMIT 10
    """
)
def quantized_search_coarse(spark, folder):
    plain = _embeddings(spark, folder)
    coll = quantize.quantized(plain, quantile=QUANTILE, vector_col="embedding")
    return _rounded(quantize.quantized_search(coll, _query(plain), 10, rescore=False, **NAMES))


@register()
def approx_search(spark, folder):
    """The ten nearest records to every record, among those that share a hash bucket."""
    coll = _embeddings(spark, folder)
    model = approx.fit_hashes(coll, vector_col="embedding")
    index = approx.build_index(coll, model, **NAMES)
    return _rounded(approx.approx_search(index, _queries(coll), model, 10, **NAMES))


@register()
def approx_recall(spark, folder):
    """How many of the exact ten nearest records the approximate search finds, over all queries."""
    coll = _embeddings(spark, folder)
    exact = knn.search_batch(coll, _queries(coll), 10, **NAMES).select("query_id", "vec_id")
    near = approx_search(spark, folder).select("query_id", "vec_id", F.lit(1).alias("found"))
    both = exact.join(near, ["query_id", "vec_id"], "left")
    return both.agg(F.count(F.lit(1)).alias("wanted"), F.count("found").alias("found"))


_REPRESENTED = "SELECT min(vec_id) AS vec_id, embedding::DOUBLE[] AS e FROM embeddings GROUP BY embedding"
_PAIRS = f"""
c AS ({_REPRESENTED}),
p AS (SELECT a.vec_id AS id_a, b.vec_id AS id_b, list_cosine_similarity(a.e, b.e) AS raw FROM c a JOIN c b ON a.vec_id < b.vec_id)
"""
#: Share of the pairs at the threshold that the registered joins may miss.
MISS = 1e-7


@register(f"WITH {_PAIRS} SELECT id_a, id_b, round(raw, 6) AS score FROM p WHERE raw >= 0.4")
def similar_pairs(spark, folder):
    """All pairs of different vectors whose cosine similarity is at least 0.4."""
    return _rounded(similarity_join.similar_pairs(_embeddings(spark, folder), 0.4, miss=MISS, **NAMES))


@register(
    f"""
    WITH {_PAIRS}, l AS (SELECT unnest([id_a, id_b]) AS class FROM p WHERE raw >= 0.4),
    n AS (SELECT class, count(*) AS links FROM l GROUP BY class),
    m AS (SELECT vec_id, min(vec_id) OVER (PARTITION BY embedding) AS class FROM embeddings)
    SELECT vec_id, class, coalesce(links, 0) AS links FROM m LEFT JOIN n USING (class)
    """
)
def similar_groups(spark, folder):
    """The class of equal vectors of every record, and how many other classes are similar to it."""
    return similarity_join.similar_groups(_embeddings(spark, folder), 0.4, miss=MISS, **NAMES)


def _cell_index(coll: DataFrame, metric: str) -> tuple[DataFrame, cells.Cells]:
    made = cells.Cells.fit(coll, metric=metric, **NAMES)
    return workspace.staged(cells.assign(coll, made, vector_col="embedding"), "cell-index"), made


@register(_BATCH.format(score=COSINE, where="", order="DESC", threshold=""))
def search_cells_exact(spark, folder):
    """The five nearest records to every record, by cells that bounds cannot rule out."""
    coll = _embeddings(spark, folder)
    index, made = _cell_index(coll, "cosine")
    return _rounded(cells.search_exact(index, _queries(coll), made, 5, **NAMES))


@register(_BATCH.format(score=DISTANCE, where="", order="ASC", threshold=""))
def search_cells_exact_euclidean(spark, folder):
    coll = _embeddings(spark, folder)
    index, made = _cell_index(coll, "euclidean")
    return _rounded(cells.search_exact(index, _queries(coll), made, 5, **NAMES))


@register(_BATCH.format(score=COSINE, where="", order="DESC", threshold=""))
def search_cells_all(spark, folder):
    """With the effort of all cells, approximate search by cells is exact."""
    coll = _embeddings(spark, folder)
    index, made = _cell_index(coll, "cosine")
    return _rounded(cells.search(index, _queries(coll), made, 5, effort=len(made.centres), **NAMES))


@register()
def search_cells_recall(spark, folder):
    """How many of the exact ten nearest records are found, by effort (cells read), over all queries."""
    coll = _embeddings(spark, folder)
    index, made = _cell_index(coll, "cosine")
    exact = workspace.staged(knn.search_batch(coll, _queries(coll), 10, **NAMES).select("query_id", "vec_id"), "exact")
    out = None
    for effort in (1, max(1, len(made.centres) // 4), max(1, len(made.centres) // 2)):
        near = cells.search(index, _queries(coll), made, 10, effort=effort, **NAMES).select("query_id", "vec_id", F.lit(1).alias("found"))
        both = exact.join(near, ["query_id", "vec_id"], "left").agg(F.count(F.lit(1)).alias("wanted"), F.count("found").alias("found"))
        one = both.select(F.lit(effort).alias("effort"), "wanted", "found")
        out = one if out is None else out.unionByName(one)
    return out
