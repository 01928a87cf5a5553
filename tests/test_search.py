"""Search against brute force, with many equal vectors, and on every route."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from semstore.errors import EmbeddingError, RecordError
from semstore.operators import approx, counts, knn, pairs, quantize, recommend, search
from semstore.plans import arguments, sizing

DIM = 8


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, DIM))
    x[::3] = x[0]  # a third of all records are copies
    x[1] = 0
    return x


@pytest.fixture(scope="module")
def coll(spark, data):
    rows = [(f"r{i:03d}", v.tolist(), i % 7) for i, v in enumerate(data)]
    return spark.createDataFrame(rows, "id string, vector array<double>, label int").repartition(6).cache()


def scores(metric, x, q):
    if metric == "dot":
        return x @ q
    if metric == "euclidean":
        return np.sqrt(((x - q) ** 2).sum(axis=1))
    scale = np.linalg.norm(x, axis=1) * np.linalg.norm(q)
    return np.divide(x @ q, scale, out=np.zeros(len(x)), where=scale > 0)


def brute(metric, data, q, k, keep=lambda i: True):
    values = np.round(scores(metric, data, q), 9)
    sign = 1 if metric == "euclidean" else -1
    order = sorted((i for i in range(len(data)) if keep(i)), key=lambda i: (sign * values[i], f"r{i:03d}"))
    return [f"r{i:03d}" for i in order[:k]]


@pytest.mark.parametrize("metric", ["cosine", "dot", "euclidean"])
def test_single_search(coll, data, metric):
    for q in (data[0], data[2], data[5] + 0.1):
        found = search.search(coll, q.tolist(), 12, metric=metric).collect()
        assert [r["id"] for r in found] == brute(metric, data, q, 12)
        assert [r["id"] for r in search.search(coll, q.tolist(), 12, metric=metric, where={"label": [1, 2]}).collect()] == brute(
            metric, data, q, 12, lambda i: i % 7 in (1, 2)
        )


def test_single_search_in_two_merges(coll, data, monkeypatch):
    monkeypatch.setattr(sizing, "MERGE_ROWS", 1)
    found = search.search(coll, data[2].tolist(), 12).collect()
    assert [r["id"] for r in found] == brute("cosine", data, data[2], 12)


def test_search_shapes(coll, data):
    q = data[2].tolist()
    assert search.search(coll, q, 3).columns == ["id", "score", "label"]
    assert search.search(coll, q, 3, with_payload=False, with_vector=True).columns == ["id", "score", "vector"]
    assert search.search(coll, q).count() == arguments.DEFAULT_TOP_K
    assert search.search(coll, q, 0).count() == arguments.DEFAULT_TOP_K
    assert {r["score"] >= 0.5 for r in search.search(coll, q, 300, score_threshold=0.5).collect()} == {True}


def test_search_refuses(coll, spark):
    with pytest.raises(RecordError):
        search.search(coll, [1.0], -1)
    with pytest.raises(Exception, match="different dimensions"):
        search.search(coll, [1.0, 2.0], 3).collect()
    with pytest.raises(RecordError, match="not found"):
        search.search(coll, coll.where("id = 'nobody'").select("vector"), 3)
    with pytest.raises(RecordError, match="one row"):
        search.search(coll, coll.select("vector"), 3)
    with pytest.raises(RecordError):
        recommend.recommend(coll, ["nobody"])
    with pytest.raises(RecordError):
        search.search(coll, coll, 3)


def asked(spark, data, **columns):
    rows = [(i, v.tolist()) for i, v in enumerate(data[:40])]
    df = spark.createDataFrame(rows, "query_id int, vector array<double>")
    return df.withColumns(columns)


ROUTES = {
    "broadcast": {},
    "blocks": {"broadcast_bytes": 7 * DIM * 8},
    "few results": {"block_winners": 40},
}


@pytest.mark.parametrize("metric", ["cosine", "dot", "euclidean"])
@pytest.mark.parametrize("route", ROUTES)
def test_batch_search(spark, coll, data, metric, route):
    found = knn.search_batch(coll, asked(spark, data), 6, metric=metric, **ROUTES[route]).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append(r["id"])
    assert got == {i: brute(metric, data, data[i], 6) for i in range(40)}


def test_batch_search_in_two_merges(spark, coll, data, monkeypatch):
    monkeypatch.setattr(sizing, "MERGE_ROWS", 1)
    found = knn.search_batch(coll, asked(spark, data), 6).collect()
    got = {(r["query_id"], r["rank"]): r["id"] for r in found}
    assert got == {(i, n + 1): name for i in range(40) for n, name in enumerate(brute("cosine", data, data[i], 6))}


@pytest.mark.parametrize("route", ROUTES)
def test_batch_search_with_own_limits_and_filters(spark, coll, data, route):
    i = F.col("query_id")
    queries = asked(
        spark, data, top_k=(i % 5).cast("int"),
        filter_name=F.when(i % 3 == 0, "low").when(i % 3 == 1, "odd"),
    )
    filters = {"low": {"label": {"lt": 2}}, "odd": {"label": [1, 3, 5]}, "unused": {"label": 0}}
    keep = {0: lambda n: n % 7 < 2, 1: lambda n: n % 7 in (1, 3, 5), 2: lambda n: True}
    found = knn.search_batch(coll, queries, filters=filters, payload=["label"], **ROUTES[route]).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        assert r["label"] == int(r["id"][1:]) % 7
        got.setdefault(r["query_id"], []).append(r["id"])
    assert got == {q: brute("cosine", data, data[q], q % 5 or 10, keep[q % 3]) for q in range(40)}


@pytest.mark.parametrize("metric", ["cosine", "dot", "euclidean"])
def test_one_huge_vector_hides_no_other(spark, metric):
    rows = [(f"k{i}", [float(i), 1.0]) for i in range(30)] + [("huge", [1e200, 1.0])]
    coll = spark.createDataFrame(rows, "id string, vector array<double>")
    queries = spark.createDataFrame([(1, [1.0, 0.5])], "query_id int, vector array<double>")
    found = [r["id"] for r in knn.search_batch(coll, queries, 31, metric=metric).orderBy("rank").collect()]
    assert found == [r["id"] for r in search.search(coll, [1.0, 0.5], 31, metric=metric).collect()]
    bad = spark.createDataFrame([(1, [float("nan"), 0.5])], "query_id int, vector array<double>")
    with pytest.raises(RecordError):
        knn.search_batch(coll, bad, 3, metric=metric)


def test_batch_search_shuffles_no_records(spark, coll, data):
    found = knn.search_batch(coll, asked(spark, data), 6, **ROUTES["blocks"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if "Exchange" in line and "vector" in line]


def test_batch_search_of_nothing(spark, coll, data):
    assert knn.search_batch(coll, asked(spark, data).limit(0), 5).count() == 0
    assert knn.search_batch(coll.limit(0), asked(spark, data), 5).count() == 0
    assert knn.search_batch(coll, asked(spark, data), 5, where={"label": 99}).count() == 0


def test_batch_search_refuses(spark, coll, data):
    with pytest.raises(RecordError):
        knn.search_batch(coll, spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "query_id int, vector array<double>"))
    with pytest.raises(RecordError, match="nobody"):
        knn.search_batch(coll, asked(spark, data, filter_name=F.lit("nobody")), filters={})
    with pytest.raises(Exception, match="different dimensions"):
        knn.search_batch(coll, spark.createDataFrame([(1, [1.0])], "query_id int, vector array<double>")).collect()


def test_winners_keep_the_smallest_ids_of_many_copies():
    import pyarrow as pa

    queries = knn.Queries(pa.array([1, 2]), np.array([[1.0, 0.0], [0.0, 1.0]]), np.array([3, 3]))
    winners = knn.Winners(queries, "cosine")
    ids = [f"{n:05d}" for n in range(20_000)]
    for start in range(19_000, -1, -1_000):
        part = ids[start : start + 1_000]
        winners.offer(pa.array(part), np.tile([1.0, 1.0], (len(part), 1)))
    table = winners.batch("id").to_pydict()
    assert table["id"] == ids[:3] * 2 and table["query_id"] == [1, 1, 1, 2, 2, 2]


@pytest.mark.parametrize("seed", range(24))
def test_winners_against_brute_force(seed):
    """Odd sizes, magnitudes far apart, copies, zero vectors, and records close together far from the origin."""
    import pyarrow as pa

    rng = np.random.default_rng(seed)
    d, n, m, k = (int(rng.integers(1, top)) for top in (70, 2_000, 40, 12))
    size = 10.0 ** rng.integers(-8, 9)
    x, q = rng.normal(size=(n, d)) * size, rng.normal(size=(m, d)) * 10.0 ** rng.integers(-8, 9)
    if seed % 3 == 0:
        x[rng.random(n) < 0.4] = x[0]
        x[rng.random(n) < 0.05] = 0
        q[0], q[-1] = 0, x[0]
    if seed % 4 == 0:
        x += 1000 * size
        q = x[rng.integers(0, n, m)] + rng.normal(size=(m, d)) * size * 1e-3
    for metric in ("cosine", "dot", "euclidean"):
        winners = knn.Winners(knn.Queries(pa.array(np.arange(m)), q, np.full(m, k)), metric)
        for part in np.array_split(rng.permutation(n), max(1, n // 500)):
            winners.offer(pa.array(part), x[part])
        got = {}
        for row in winners.batch("id").to_pylist():
            got.setdefault(row["query_id"], []).append(row["id"])
        for i in range(m):
            if metric == "euclidean":
                value = -np.sqrt(((x - q[i]) ** 2).sum(axis=1))
            else:
                value = (x * q[i]).sum(axis=1)
                if metric == "cosine":
                    scale = np.sqrt((x**2).sum(axis=1)) * np.sqrt((q[i] ** 2).sum())
                    value = np.divide(value, scale, out=np.zeros_like(value), where=scale > 0)
            assert got[i] == np.lexsort((np.arange(n), -value))[:k].tolist()


def test_rank_all_and_pairs(spark, coll, data):
    ranked = search.rank_all(coll, data[2].tolist()).collect()
    assert [r["id"] for r in ranked] == brute("cosine", data, data[2], 300)
    wanted = spark.createDataFrame([("r002", "r005"), ("r000", "r003"), ("r001", "r002"), ("r001", "zz")], "id_a string, id_b string")
    found = {(r["id_a"], r["id_b"]): r["score"] for r in pairs.pair_similarity(wanted, coll).collect()}
    assert set(found) == {("r002", "r005"), ("r000", "r003"), ("r001", "r002")}
    assert found["r000", "r003"] == pytest.approx(1) and found["r001", "r002"] == 0


def test_recommend(coll, data):
    pos, neg = [2, 4, 5], [7, 8]
    q = data[pos].mean(axis=0)
    q = q + (q - data[neg].mean(axis=0))
    names = lambda ns: [f"r{n:03d}" for n in ns]
    found = recommend.recommend(coll, names(pos), names(neg), 9).collect()
    assert [r["id"] for r in found] == brute("cosine", data, q, 9, lambda i: i not in pos + neg)
    found = recommend.recommend(coll, names(pos), None, 9, where={"label": 3}).collect()
    assert [r["id"] for r in found] == brute("cosine", data, data[pos].mean(axis=0), 9, lambda i: i not in pos and i % 7 == 3)
    with pytest.raises(RecordError):
        recommend.recommend(coll, [])


def test_approximate_search(spark, coll, data, tmp_path):
    model = approx.fit_hashes(coll, tables=6, bucket=1.0)
    index = approx.build_index(coll, model)
    approx.write_index(index, str(tmp_path / "index"))
    stored = spark.read.parquet(str(tmp_path / "index"))
    wanted = {(i, n) for i in range(40) for n in brute("cosine", data, data[i], 10)}
    for source in (index, stored):
        found = approx.approx_search(source, asked(spark, data), model, 10).collect()
        got = {(r["query_id"], r["id"]) for r in found}
        assert len(got) == len(found)
        assert len(got & wanted) / len(wanted) > 0.9
        assert {r["rank"] for r in found} <= set(range(1, 11))
    few = approx.approx_search(stored, asked(spark, data), model, 10, tables=1).collect()
    assert len({(r["query_id"], r["id"]) for r in few} & wanted) <= len(got & wanted)


def test_approximate_search_in_buckets(spark, coll, data, monkeypatch):
    """The route for very many queries, with buckets cut into blocks: a third of the records share theirs."""
    model = approx.fit_hashes(coll)
    index = approx.build_index(coll, model)
    whole = approx.approx_search(index, asked(spark, data), model, 5).collect()
    monkeypatch.setattr(sizing, "QUERY_BROADCAST_BYTES", 0)
    monkeypatch.setattr(approx, "ROWS_PER_BLOCK", 40)
    monkeypatch.setattr(approx, "QUERIES_PER_BLOCK", 7)
    shuffled = approx.approx_search(index, asked(spark, data), model, 5).collect()
    key = lambda rows: sorted((r["query_id"], r["rank"], r["id"]) for r in rows)
    assert key(whole) == key(shuffled)


def test_quantized_search(coll, data):
    coded = quantize.quantized(coll, quantile=1.0)
    low, high = quantize.bounds(coll, 1.0).first()
    assert low == pytest.approx(data.min()) and high == pytest.approx(data.max())
    step = (high - low) / 255
    rows = coded.select("vector", quantize.decode(F.col("code"), F.col("code_low"), F.col("code_high")).alias("near")).collect()
    assert max(abs(np.array(r["vector"]) - np.array(r["near"])).max() for r in rows) <= step / 2 + 1e-9
    q = data[5].tolist()
    exact = [r["id"] for r in search.search(coll, q, 5).collect()]
    assert [r["id"] for r in quantize.quantized_search(coded, q, 5, ignore=True).collect()] == exact
    assert [r["id"] for r in quantize.quantized_search(coded, q, 5, oversampling=60).collect()] == exact
    assert quantize.quantized_search(coded, q, 5).columns == ["id", "score", "label"]
    assert len(quantize.quantized_search(coded, q, 5, rescore=False).collect()) == 5


def test_quantization_bounds_leave_out_the_tails(spark):
    rows = [(i, [float(i)]) for i in range(1000)] + [(-1, [1e6])]
    df = spark.createDataFrame(rows, "id int, vector array<double>")
    low, high = quantize.bounds(df, 0.9).first()
    assert low >= 0 and high < 1e6
    constant = spark.createDataFrame([(1, [2.0, 2.0])], "id int, vector array<double>")
    assert quantize.quantized(constant).first()["code"] == [-128, -128]


def test_dimensions(spark):
    rows = [(3, [1.0]), (1, [1.0, 2.0]), (2, [3.0, 4.0]), (4, [1.0])]
    df = spark.createDataFrame(rows, "id int, vector array<double>")
    row = counts.dimensions(df).first()
    assert (row["expected_dim"], row["offender_id"], row["offender_dim"]) == (2, 3, 1)
    with pytest.raises(EmbeddingError, match="record 3"):
        counts.require_one_dimension(df)
    counts.require_one_dimension(df.where("id < 3"))
    counts.require_one_dimension(df.limit(0))


def test_many_queries_travel_in_small_blocks(spark, monkeypatch):
    """A task holds a block of the queries, however many there are, and what the records are made by runs once."""
    blocks, whole = [], knn.per_task
    monkeypatch.setattr(knn, "per_task", lambda rows, queries, *more: blocks.append((rows, queries)) or whole(rows, queries, *more))
    random = F.transform(F.sequence(F.lit(1), F.lit(64)), lambda i: F.xxhash64("id", i).cast("double"))
    queries = spark.range(40_000).select(F.col("id").alias("query_id"), random.alias("vector"))
    coll = spark.range(30).select("id", random.alias("vector"))
    found = knn.search_batch(coll, queries, 2)
    assert found.count() == 80_000
    assert len(blocks) > 1 and sum(len(q.keys) for _, q in blocks) == 40_000
    assert max(q.vectors.nbytes for _, q in blocks) < 12 << 20
    assert all("Range" not in rows._jdf.queryExecution().optimizedPlan().toString() for rows, _ in blocks)


def test_queries_of_large_buckets_are_not_shuffled(spark, coll, data, monkeypatch):
    """Where each record would be sent to many blocks of queries, the queries come to the records in blocks."""
    model = approx.fit_hashes(coll)
    index = approx.build_index(coll, model)
    whole = approx.approx_search(index, asked(spark, data), model, 5)
    types = (5, "cosine", None, "id", "vector", 1_000)
    hashed = approx._buckets(asked(spark, data), model, "vector")
    monkeypatch.setattr(approx, "QUERIES_PER_BLOCK", 1)
    blocks = approx.in_buckets(index, hashed, asked(spark, data), *types)
    assert "CoGroup" not in blocks._jdf.queryExecution().optimizedPlan().toString()
    key = lambda df: sorted((r["query_id"], r["rank"], r["id"]) for r in df.collect())
    assert key(blocks) == key(whole)
