"""Search by cells: recall by effort, exactness under pruning, what is read."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from semstore.errors import RecordError
from semstore.operators import approx, cells, knn

SCHEMA = "id long, vector array<double>"
GROUPS = 30


@pytest.fixture(scope="module")
def points():
    random = np.random.default_rng(5)
    centres = random.normal(size=(GROUPS, 16)) * 3
    return np.repeat(centres, 50, axis=0) + random.normal(size=(GROUPS * 50, 16)) * 0.4


@pytest.fixture(scope="module")
def coll(spark, points):
    return spark.createDataFrame([(i, v) for i, v in enumerate(points.tolist())], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def queries(spark, points):
    random = np.random.default_rng(6)
    asked = points[::37] + random.normal(size=points[::37].shape) * 0.2
    return spark.createDataFrame([(i, v) for i, v in enumerate(asked.tolist())], "query_id long, vector array<double>").cache()


def rows(df):
    return sorted((r.query_id, r["rank"], r.id, round(r.score, 9)) for r in df.collect())


def indexed(coll, metric, n=GROUPS):
    made = cells.Cells.fit(coll, n, metric=metric)
    return cells.assign(coll, made).cache(), made


@pytest.mark.parametrize("metric", ["cosine", "euclidean"])
@pytest.mark.parametrize("broadcast_bytes", [1 << 26, 0])
def test_exact_search_reads_few_cells(coll, queries, metric, broadcast_bytes):
    """The results of a full search, with cells skipped, by broadcast and by shuffle."""
    index, made = indexed(coll, metric)
    want = rows(knn.search_batch(coll, queries, 7, metric=metric))
    assert rows(cells.search_exact(index, queries, made, 7, broadcast_bytes=broadcast_bytes)) == want
    options = (7, metric, None, "id", "vector", broadcast_bytes)
    first, other = cells.bounds(index, cells._buckets_of(index, "id", "vector"), queries, made, options)
    read = other.select((F.size("_seen") + F.size("_buckets")).alias("n")).agg(F.avg("n")).first()[0]
    assert read < 0.3 * GROUPS


def test_exact_search_where_bounds_are_of_no_use(spark):
    """Directions at random, ties, zero vectors, fewer records than wanted, more results than a cell holds."""
    random = np.random.default_rng(8)
    x = random.normal(size=(300, 12))
    x[50:60], x[70:75] = x[49], 0
    coll = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], SCHEMA)
    queries = coll.where("id % 7 = 0 OR id IN (50, 72)").select(F.col("id").alias("query_id"), "vector")
    for metric in ("cosine", "euclidean"):
        index, made = indexed(coll, metric, 12)
        for k in (1, 40, 500):
            assert rows(cells.search_exact(index, queries, made, k)) == rows(knn.search_batch(coll, queries, k, metric=metric))
    some = cells.search_exact(index, queries, made, 5, score_threshold=2.0)
    assert rows(some) == rows(knn.search_batch(coll, queries, 5, metric="euclidean", score_threshold=2.0))


def test_recall_grows_with_effort(spark):
    """On vectors without any structure, the hardest case: a share of the cells finds a larger share of the neighbours."""
    coll = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").selectExpr("vec_id AS id", "embedding AS vector")
    queries = coll.select(F.col("id").alias("query_id"), "vector")
    index, made = indexed(coll, "cosine", 20)
    exact = {(q, i) for q, _, i, _ in rows(knn.search_batch(coll, queries, 10))}
    recall = {e: len(exact & {(q, i) for q, _, i, _ in rows(cells.search(index, queries, made, 10, effort=e))}) / len(exact) for e in (1, 5, 12, 20)}
    assert recall[1] < recall[5] < recall[12] < recall[20] == 1.0
    assert recall[5] >= 0.6 and recall[12] >= 0.9


def test_recall_of_hashing_and_of_clustered_cells(coll, queries):
    exact = {(q, i) for q, _, i, _ in rows(knn.search_batch(coll, queries, 10))}
    index, made = indexed(coll, "cosine")
    found = {(q, i) for q, _, i, _ in rows(cells.search(index, queries, made, 10, effort=3))}
    assert len(found & exact) >= 0.95 * len(exact)
    model = approx.fit_hashes(coll)
    hashed = {(q, i) for q, _, i, _ in rows(approx.approx_search(approx.build_index(coll, model), queries, model, 10))}
    assert len(hashed & exact) >= 0.9 * len(exact)


def test_an_index_on_disk_is_read_by_cell(spark, coll, queries, tmp_path):
    made = cells.Cells.fit(coll, GROUPS)
    made.save(spark, str(tmp_path / "centres"))
    made = cells.Cells.load(spark, str(tmp_path / "centres"), "cosine")
    cells.write_index(cells.assign(coll, made), str(tmp_path / "index"))
    index = spark.read.parquet(str(tmp_path / "index"))
    assert index.count() == coll.count()  # every vector is stored once
    one = queries.limit(1)
    found = cells.search(index, one, made, 5, effort=2)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    (vector,) = (r.vector for r in one.collect())
    chosen = cells.near(made, vector, 2)
    assert len(index.where(cells.in_cells(chosen, F.col("cell"))).inputFiles()) >= 1
    assert rows(found) == rows(cells.search(cells.assign(coll, made), one, made, 5, effort=2))


def test_assignment_and_refusals(spark, coll):
    made = cells.Cells.fit(coll, 5, metric="euclidean", sample_rows=200)
    assert made.centres.shape[0] == 5
    odd = coll.limit(3).union(spark.createDataFrame([(-1, None)], SCHEMA)).withColumn("more", F.lit("x"))
    got = cells.assign(odd, made)
    assert got.columns == ["id", "vector", "more", "cell", "reach"]
    assert [r.cell for r in got.where("id = -1").collect()] == [None] and got.where("cell IS NULL").count() == 1
    assert cells.assign(got, made).columns == got.columns
    assert cells.assign(coll.where("false"), made).count() == 0
    with pytest.raises(RecordError):
        cells.Cells.fit(coll.where("false"))
    with pytest.raises(RecordError):
        cells.Cells.fit(coll, 0)
    with pytest.raises(RecordError):
        cells.probes(coll.withColumnRenamed("id", "query_id"), made, 0)
    dot = cells.Cells(made.centres, "dot")
    with pytest.raises(RecordError):
        cells.search_exact(got, coll.withColumnRenamed("id", "query_id"), dot, 3)


@pytest.mark.parametrize("broadcast_bytes", [1 << 26, 2_000])
def test_no_pair_of_query_and_cell_leaves_a_task(spark, coll, queries, monkeypatch, broadcast_bytes):
    """Queries travel with their vectors only, however many cells they look at."""
    sent, whole = [], knn.per_task
    monkeypatch.setattr(knn, "per_task", lambda rows, asked, *more: sent.append(asked) or whole(rows, asked, *more))
    index, made = indexed(coll, "cosine")
    want = rows(knn.search_batch(coll, queries, 4))
    sent.clear()
    found = cells.search(index, queries, made, 4, effort=GROUPS, broadcast_bytes=broadcast_bytes)
    assert rows(found) == want
    exact = cells.search_exact(index, queries, made, 4, broadcast_bytes=broadcast_bytes)
    assert rows(exact) == want
    assert sent and all(not asked.groups for asked in sent)
    assert "CoGroup" not in exact._jdf.queryExecution().optimizedPlan().toString()
