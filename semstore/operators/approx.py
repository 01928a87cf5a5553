"""Approximate search: random-projection hashing picks the candidates, exact scores rank them."""

from __future__ import annotations

import math

from pyspark.ml.feature import BucketedRandomProjectionLSH, BucketedRandomProjectionLSHModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from semstore.errors import RecordError
from semstore.functions import vectors
from semstore.operators import knn, ranking
from semstore.plans import arguments, sizing, workspace

ROWS_PER_BLOCK = 100_000
QUERIES_PER_BLOCK = 20_000
#: How often a row may be shuffled in the mean; beyond that, the queries go to the records in blocks.
_MOST_MOVED = 2


def fit_hashes(
    coll: DataFrame, *, tables: int = 6, bucket: float = 1.0, seed: int = 7, vector_col: str = "vector"
) -> BucketedRandomProjectionLSHModel:
    """Draw the random projections; reads the first vector only, for its dimension."""
    lsh = BucketedRandomProjectionLSH(
        inputCol="_unit", outputCol="_hashes", bucketLength=bucket, numHashTables=tables, seed=seed
    )
    return lsh.fit(_with_unit(coll.limit(1), vector_col))


def _with_unit(df: DataFrame, vector_col: str) -> DataFrame:
    # Hashing unit vectors makes near in angle mean near in distance.
    return df.withColumn("_unit", array_to_vector(vectors.normalize(F.col(vector_col))))


def _buckets(df: DataFrame, model: BucketedRandomProjectionLSHModel, vector_col: str) -> DataFrame:
    hashed = model.transform(_with_unit(df, vector_col))
    numbers = F.transform("_hashes", lambda h: _only_number(h))
    keys = F.transform(numbers, lambda b, i: F.xxhash64(i, b))
    return hashed.withColumn("_buckets", keys).drop("_unit", "_hashes")


def _only_number(h: Column) -> Column:
    """The single number in each table's hash."""
    return F.element_at(vector_to_array(h), 1).cast("bigint")


def build_index(
    coll: DataFrame, model: BucketedRandomProjectionLSHModel, *, id_col: str = "id", vector_col: str = "vector"
) -> DataFrame:
    """One row per record and hash table: ``bucket``, id, vector."""
    hashed = _buckets(coll.select(id_col, vector_col), model, vector_col)
    return hashed.select(F.explode("_buckets").alias("bucket"), id_col, vector_col)


def write_index(index: DataFrame, path: str, id_col: str = "id") -> None:
    """Write an index ordered by bucket, so that a search reads the row groups of its buckets only.

    The range split goes on with a hash of the id: a bucket with very many records covers several files.
    """
    spread = index.repartitionByRange("bucket", F.xxhash64(id_col))
    spread.sortWithinPartitions("bucket").write.mode("errorifexists").parquet(path)


def approx_search(
    index: DataFrame,
    queries: DataFrame,
    model: BucketedRandomProjectionLSHModel,
    top_k: int | None = None,
    *,
    tables: int | None = None,
    metric: str = "cosine",
    score_threshold: float | None = None,
    id_col: str = "id",
    vector_col: str = "vector",
) -> DataFrame:
    """``query_id, id, score, rank`` among the records that share a bucket with the query.

    ``tables`` looks at the first so many hash tables only: faster, with a lower recall. The candidates are scored
    where they are read, so a bucket of any size is only ever streamed over, and none of it is left out.
    """
    k = arguments.top_k(top_k)
    metric = vectors.check_metric(metric)
    hashed = _buckets(queries.select("query_id", knn.plain(queries, "vector").alias("vector")), model, "vector")
    if tables is not None:
        if tables < 1:
            raise RecordError("at least one hash table is needed")
        hashed = hashed.withColumn("_buckets", F.slice("_buckets", 1, tables))
    return in_buckets(index, hashed, queries, k, metric, score_threshold, id_col, vector_col)


def in_buckets(
    index: DataFrame,
    hashed: DataFrame,
    queries: DataFrame,
    k: int,
    metric: str,
    score_threshold: float | None,
    id_col: str,
    vector_col: str,
    broadcast_bytes: int = sizing.QUERY_BROADCAST_BYTES,
) -> DataFrame:
    """The nearest records to every query among those in its ``_buckets``; ``index`` has bucket, id and vector."""
    hashed = hashed.select("query_id", knn.plain(hashed, "vector").alias("vector"), F.array_distinct("_buckets").alias("_buckets"))
    n, dim, lists = hashed.agg(F.count(F.lit(1)), F.max(F.size("vector")), F.sum(F.size("_buckets"))).first()
    workspace.ship_package(index.sparkSession)
    types = {**dict(index.dtypes), "query_id": dict(queries.dtypes)["query_id"]}
    schema = f"query_id {types['query_id']}, `{id_col}` {types[id_col]}, score double"
    if n == 0:
        return index.sparkSession.createDataFrame([], schema + ", rank int")

    n_blocks = knn.block_count(n, dim * 8 + math.ceil((lists or 0) / n) * 8, k, broadcast_bytes)
    if n_blocks == 1:
        found = _broadcast_queries(index, hashed, metric, k, id_col, vector_col, schema)
    else:
        index = workspace.staged(index.select("bucket", id_col, knn.plain(index, vector_col).alias(vector_col)), "index-rows")
        hashed = workspace.staged(hashed, "hashed-queries")
        if _meeting_moves(index, hashed) <= _MOST_MOVED:
            found = _meet_in_buckets(index, hashed, metric, k, id_col, vector_col, schema)
        else:
            rows = index.select(id_col, F.col(vector_col).alias("vector"), "bucket")
            found = knn.in_passes(rows, hashed, n_blocks, metric, k, [], id_col, schema)
    ranked = ranking.best_per_query(found, k, metric, id_col, sizing.scan_tasks(index), repeated=True)
    if score_threshold is not None:
        ranked = ranked.where(ranking.beyond(metric, score_threshold))
    return ranked.select("query_id", id_col, "score", "rank")


def _broadcast_queries(
    index: DataFrame, hashed: DataFrame, metric: str, k: int, id_col: str, vector_col: str, schema: str
) -> DataFrame:
    block = knn._queries(hashed.toArrow(), k)
    rows = index.select(id_col, knn.plain(index, vector_col).alias("vector"), "bucket")
    # Few buckets go into the scan as literals; for more, the tasks do the look-up.
    if len(block.groups) <= sizing.LITERAL_IDS:
        rows = rows.where(F.col("bucket").isin([b for b in block.groups if b is not None]))
    return knn.per_task(rows, block, metric, [], id_col, schema)


def _meeting_moves(index: DataFrame, hashed: DataFrame) -> float:
    """How often a row is moved, in the mean, if records and queries are shuffled to their buckets, large ones in blocks."""
    asked = hashed.select(F.explode("_buckets").alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("q"))
    held = index.groupBy("bucket").agg(F.count(F.lit(1)).alias("r")).join(asked, "bucket")
    sent = F.col("r") * F.ceil(F.col("q") / QUERIES_PER_BLOCK) + F.col("q") * F.ceil(F.col("r") / ROWS_PER_BLOCK)
    moved, rows = held.agg(F.sum(sent), F.sum(F.col("r") + F.col("q"))).first()
    return (moved or 0) / (rows or 1)


def _meet_in_buckets(
    index: DataFrame, hashed: DataFrame, metric: str, k: int, id_col: str, vector_col: str, schema: str
) -> DataFrame:
    """For more queries than one broadcast holds, and buckets that are small: records and queries are shuffled to them.

    A bucket with many records, many queries or both is cut into blocks by a hash of the ids, every block of records
    meeting every block of queries, so that no task gets more than about one block of each.
    """
    asked = hashed.select(F.explode("_buckets").alias("bucket"), "query_id", "vector")
    wanted = asked.select("bucket").distinct()
    rows = index.select("bucket", id_col, F.col(vector_col).alias("vector"))
    rows = rows.join(wanted, "bucket", "left_semi")
    pieces = lambda df, name, most: df.groupBy("bucket").agg(
        F.ceil(F.count(F.lit(1)) / most).cast("int").alias(name)
    )
    sizes = pieces(rows, "_row_blocks", ROWS_PER_BLOCK).join(pieces(asked, "_query_blocks", QUERIES_PER_BLOCK), "bucket")
    # Only the few buckets that are cut at all are looked up; all others are one block.
    cut = sizes.where((F.col("_row_blocks") > 1) | (F.col("_query_blocks") > 1))

    def dealt(df: DataFrame, own: str, own_block: str, key: str, other: str, other_block: str) -> DataFrame:
        sized = df.join(cut, "bucket", "left").withColumns({c: F.coalesce(c, F.lit(1)) for c in (own, other)})
        block = F.pmod(F.xxhash64(key), F.col(own)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        return sized.select("bucket", block.alias(own_block), every.alias(other_block), key, "vector")

    left = dealt(rows, "_row_blocks", "_row_block", id_col, "_query_blocks", "_query_block")
    right = dealt(asked, "_query_blocks", "_query_block", "query_id", "_row_blocks", "_row_block")
    keys = ("bucket", "_row_block", "_query_block")
    work = knn.block_worker(metric, k, [], id_col, keys)
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(work, schema)
