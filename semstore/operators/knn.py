"""Many similarity queries in one pass over a collection.

The queries travel to the collection, never the collection to the queries. Each task multiplies Arrow batches of
vectors with the query matrix and hands on its k best per query; no (query, record) pair is ever a row. Up to
``sizing.QUERY_BROADCAST_BYTES`` of query vectors are broadcast. More of them, or queries that want more results than a
task should hold, are worked off in blocks of that size, one pass over the records each. All ways are exact.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from semstore.errors import EmbeddingError, RecordError
from semstore.functions import vectors
from semstore.operators import ranking
from semstore.operators.filters import predicate
from semstore.plans import arguments, sizing, workspace

_TILE = 2 * 1024 * 1024  # scores held at a time
_WINNER_BYTES = 64  # one result row
_BLOCK_WINNERS = 500_000  # results of one block of queries that a task may hold
_FLAG = "filter:"
_LARGE = 1e100  # norms below this have finite squares and products


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A list column as a matrix of doubles; all lists must have one length."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = len(column)
    values = column.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(column.offsets.to_numpy())
    if column.null_count or (rows and (sizes != sizes[0]).any()):
        raise EmbeddingError("the vectors have different dimensions")
    return np.ascontiguousarray(values, dtype=np.float64).reshape(rows, -1)


@dataclass
class Queries:
    """Query vectors with their keys, the most results each wants, and the filter or buckets it looks at."""

    keys: pa.Array
    vectors: np.ndarray
    limits: np.ndarray
    groups: Mapping = field(default_factory=dict)  # filter name or bucket -> indexes of queries
    bounds: np.ndarray | None = None  # what a choice of buckets goes by, beside the vectors

    @property
    def k(self) -> int:
        return int(self.limits.max())


def _unit(x: np.ndarray, norms: np.ndarray) -> np.ndarray:
    return x * np.divide(1.0, norms, out=np.zeros_like(norms), where=norms > 0)[:, None]


def _norms(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore", invalid="ignore"):
        return np.sqrt((x**2).sum(axis=1))


class Winners:
    """The k best records per query seen so far by one task.

    A matrix product with quick scores leaves out nearly all records; those that may be among the best, given how far
    off a quick score can be, get exact scores. Both sides of the product are scaled to norms of at most one, where
    the rounding error of a sum of ``d`` products is at most about ``d`` units in the last place.
    """

    def __init__(self, queries: Queries, metric: str) -> None:
        self.queries = queries
        self.metric = metric
        self.sign = -1.0 if metric in vectors.ASCENDING else 1.0
        self.norms = _norms(queries.vectors)
        self.kth = np.full(len(queries.keys), -np.inf)  # the score to beat, signed so that larger is better
        self.parts: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []
        self.waiting = 0
        # Distances are differences of large numbers, so they are not left to single precision.
        self.type = np.float64 if metric == "euclidean" else np.float32
        left = queries.vectors
        if metric == "euclidean":
            # |x - q|^2 <= r^2 says the same as (2q, -1).(x, |x|^2) >= |q|^2 - r^2: a product and a bound per query.
            left = np.column_stack([2 * left, np.full(len(left), -1.0)])
        self.left_norms = _norms(left)
        self.left = _unit(left, self.left_norms).astype(self.type)
        self.slack = (left.shape[1] + 8) * 2 * float(np.finfo(self.type).eps)

    def offer(self, ids: pa.Array, x: np.ndarray, chosen: np.ndarray | None = None) -> None:
        """Score records against the chosen queries and keep what may be among the best."""
        if not len(x):
            return
        if x.shape[1] != self.queries.vectors.shape[1]:
            raise EmbeddingError("vectors of different dimensions cannot be compared")
        chosen = np.arange(len(self.kth)) if chosen is None else chosen
        odd = ~(_norms(x) < _LARGE)
        if odd.any():
            # too large for the bounds of quick scores, or not finite: scored exactly
            self._exactly(ids.take(pa.array(np.flatnonzero(odd))), x[odd], chosen)
            ids, x = ids.take(pa.array(np.flatnonzero(~odd))), x[~odd]
        width = min(len(chosen), 2048)
        height = max(1, _TILE // max(1, width))
        for top in range(0, len(x), height):
            rows = x[top : top + height]
            norms = _norms(rows)
            right, scale = self._right(rows, norms)
            for start in range(0, len(chosen), width):
                self._tile(ids, rows, norms, right, scale, top, chosen[start : start + width])

    def _exactly(self, ids: pa.Array, x: np.ndarray, chosen: np.ndarray) -> None:
        """Score records against the chosen queries without quick scores; scores that are no number are left out."""
        norms = _norms(x)
        step = max(1, _TILE // (8 * len(chosen)))
        for start in range(0, len(x), step):
            at_x = np.repeat(np.arange(start, min(start + step, len(x))), len(chosen))
            at_q = np.tile(chosen, len(at_x) // len(chosen))
            with np.errstate(over="ignore", invalid="ignore"):
                exact = self._exact(x, norms, at_x, at_q)
            number = ~np.isnan(exact)
            self.parts.append((at_q[number], exact[number], ids.take(pa.array(at_x[number]))))
            self.waiting += int(number.sum())
            if self.waiting > 4 * self.queries.k * len(self.kth) + 100_000:
                self._settle()

    def _right(self, x: np.ndarray, norms: np.ndarray) -> tuple[np.ndarray, float]:
        """The records' side of the product, and what it was divided by."""
        if self.metric == "cosine":
            return _unit(x, norms).astype(self.type), 1.0
        if self.metric == "euclidean":
            x = np.column_stack([x, norms**2])
            norms = _norms(x)
        scale = float(norms.max()) or 1.0
        return (x / scale).astype(self.type), scale

    def _bound(self, chosen: np.ndarray, scale: float, kth: np.ndarray) -> np.ndarray:
        """The quick scores below which no record can reach the exact score ``kth``."""
        if self.metric == "cosine":
            return kth - self.slack
        divisor = np.where(self.left_norms[chosen] > 0, self.left_norms[chosen], 1.0) * scale
        if self.metric == "dot":
            return kth / divisor - self.slack
        # Distances close to each other on the scale of the query come out equal, and equal ones must all be seen.
        own, reach = self.norms[chosen] ** 2, np.square(kth)
        return (own - reach - self.slack * (own + reach)) / divisor - self.slack

    def _kth_of(self, quick: np.ndarray, chosen: np.ndarray, scale: float) -> np.ndarray:
        """A lower limit of the k-th best exact score in a tile, from its quick scores."""
        at = quick.shape[1] - self.queries.k
        kth = np.partition(quick, at, axis=1)[:, at].astype(np.float64) - self.slack
        if self.metric == "cosine":
            return kth
        kth *= np.where(self.left_norms[chosen] > 0, self.left_norms[chosen], 1.0) * scale
        if self.metric == "dot":
            return kth
        return -np.sqrt(np.maximum(self.norms[chosen] ** 2 - kth, 0)) * (1 + self.slack)

    def _tile(self, ids, x, x_norms, right, scale, first: int, chosen: np.ndarray) -> None:
        quick = self.left[chosen] @ right.T
        k, kth = self.queries.k, self.kth[chosen]
        likely = quick >= self._bound(chosen, scale, kth)[:, None].astype(self.type)
        if len(x) > k and np.count_nonzero(likely) > 4 * k * len(chosen):
            # Not enough is known yet: these records alone give a score to beat.
            kth = np.maximum(kth, self._kth_of(quick, chosen, scale))
            likely = quick >= self._bound(chosen, scale, kth)[:, None].astype(self.type)
        at_q, at_x = np.divmod(np.flatnonzero(likely), len(x))
        if not len(at_q):
            return
        if len(at_x) > 8 * k * len(chosen) + 1024:
            at_q, at_x = self._without_spare_copies(ids, x, first, at_q, at_x)
        exact = self._exact(x, x_norms, at_x, chosen[at_q])
        self.parts.append((chosen[at_q], exact, ids.take(pa.array(at_x + first))))
        self.waiting += len(at_x)
        if self.waiting > 4 * k * len(self.kth) + 100_000:
            self._settle()

    def _exact(self, x: np.ndarray, x_norms: np.ndarray, at_x: np.ndarray, at_q: np.ndarray) -> np.ndarray:
        """Scores in double precision, whose sums do not depend on the place in a matrix: equal vectors tie."""
        exact = np.empty(len(at_x))
        for i in range(0, len(at_x), 16_384):
            part = slice(i, i + 16_384)
            a, b = x[at_x[part]], self.queries.vectors[at_q[part]]
            if self.metric == "euclidean":
                exact[part] = _norms(a - b)
                continue
            product = (a * b).sum(axis=1)
            if self.metric == "cosine":
                scale = x_norms[at_x[part]] * self.norms[at_q[part]]
                product = np.divide(product, scale, out=np.zeros_like(product), where=scale > 0)
            exact[part] = product
        return exact

    def _without_spare_copies(self, ids, x, first, at_q, at_x):
        """Of records with equal vectors only the k smallest ids can win; the others are left out."""
        used = np.unique(at_x)
        whole = np.ascontiguousarray(x[used]).view(np.dtype((np.void, x.shape[1] * 8))).ravel()
        _, copy_of = np.unique(whole, return_inverse=True)
        by_id = pc.array_sort_indices(ids.take(pa.array(used + first))).to_numpy()
        order = by_id[np.argsort(copy_of[by_id], kind="stable")]
        position = _position_in_run(copy_of[order])
        useful = np.zeros(len(x), dtype=bool)
        useful[used[order[position < self.queries.k]]] = True
        kept = useful[at_x]
        return at_q[kept], at_x[kept]

    def _settle(self) -> pa.Table:
        """Cut what has gathered to the k best per query."""
        table = pa.table(
            {
                "q": np.concatenate([p[0] for p in self.parts]),
                "s": np.concatenate([p[1] for p in self.parts]) * self.sign,
                "id": pa.chunked_array([p[2] for p in self.parts]),
            }
        ).sort_by([("q", "ascending"), ("s", "descending"), ("id", "ascending")])
        # A record met in several buckets has the same score each time, so its copies lie side by side.
        ids = table["id"].combine_chunks()
        q = table["q"].to_numpy()
        if len(q) > 1:
            again = (q[1:] == q[:-1]) & pc.equal(ids[1:], ids[:-1]).to_numpy(zero_copy_only=False)
            fresh = np.concatenate([[True], ~again])
            if not fresh.all():
                table, q = table.filter(pa.array(fresh)), q[fresh]
        position = _position_in_run(q)
        table = table.filter(pa.array(position < self.queries.k))
        q, s = table["q"].to_numpy(), table["s"].to_numpy()
        last = _position_in_run(q) == self.queries.k - 1
        self.kth[q[last]] = s[last]
        self.parts = [(q, s * self.sign, table["id"].combine_chunks())]
        self.waiting = 0
        return table

    def batch(self, id_col: str) -> pa.Table | None:
        """The winners as ``query_id, id, score``."""
        if not self.parts:
            return None
        table = self._settle()
        q = table["q"].to_numpy()
        wanted = _position_in_run(q) < self.queries.limits[q]
        table, q = table.filter(pa.array(wanted)), q[wanted]
        scores = pa.array(table["s"].to_numpy() * self.sign)
        ids = table["id"].combine_chunks()
        return pa.table({"query_id": self.queries.keys.take(pa.array(q)), id_col: ids, "score": scores})


def _position_in_run(values: np.ndarray) -> np.ndarray:
    """0, 1, 2 ... within every run of equal values."""
    if not len(values):
        return np.zeros(0, dtype=np.int64)
    starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    lengths = np.diff(np.append(starts, len(values)))
    return np.arange(len(values)) - np.repeat(starts, lengths)


def _offer(winners: Winners, queries: Queries, batch, flags: list[str]) -> None:
    """Offer one batch: whole, per named filter, or per bucket of an index."""
    ids, x = _whole(batch.column(0)), matrix(batch.column(1))
    if not queries.groups:
        winners.offer(ids, x)
    elif flags:
        for i, name in enumerate(flags):
            rows = np.flatnonzero(_whole(batch.column(2 + i)).to_numpy(zero_copy_only=False))
            winners.offer(ids.take(pa.array(rows)), x[rows], queries.groups[name])
    else:
        buckets = _whole(batch.column(2)).to_numpy()
        order = np.argsort(buckets, kind="stable")
        values, starts = np.unique(buckets[order], return_index=True)
        ends = np.append(starts[1:], len(order))
        for value, start, end in zip(values.tolist(), starts, ends, strict=True):
            asking = queries.groups.get(value)
            if asking is not None:
                rows = np.sort(order[start:end])
                winners.offer(ids.take(pa.array(rows)), x[rows], asking)


def _whole(column) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def plain(df: DataFrame, name: str) -> Column:
    """A vector column as it is where it holds floats or doubles, which `matrix` takes alike; else as doubles."""
    return F.col(name) if dict(df.dtypes)[name] in ("array<float>", "array<double>") else vectors.as_double(F.col(name))


def per_task(
    rows: DataFrame, queries: Queries, metric: str, flags: list[str], id_col: str, schema: str, choose: Callable[[Queries], Mapping] | None = None
) -> DataFrame:
    """The winners of every task, the queries being broadcast. Columns of ``rows``: id, vector, flags or bucket.

    With ``choose``, the tasks themselves work out which queries look at which buckets.
    """
    workspace.ship_package(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(queries)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = winners = None
        for batch in batches:
            if winners is None:
                known = replace(shared.value, groups=choose(shared.value)) if choose else shared.value
                winners = Winners(known, metric)
            _offer(winners, known, batch, flags)
        found = winners.batch(id_col) if winners else None
        if found is not None:
            yield from found.to_batches(max_chunksize=65_536)

    return rows.mapInArrow(work, schema)


def blocks_of(asked: DataFrame, n_blocks: int) -> Iterator[pa.Table]:
    """The queries in blocks of about equal size; the driver sees one after the other."""
    if n_blocks <= 1:
        yield asked.toArrow()
        return
    spark = asked.sparkSession
    path = workspace.new_path(spark, "query-blocks")
    dealt = asked.withColumn("_block", F.pmod(F.xxhash64("query_id", "vector"), F.lit(n_blocks)).cast("int"))
    dealt.repartition("_block").write.partitionBy("_block").parquet(path)
    kept = spark.read.schema(T.StructType([*asked.schema.fields, T.StructField("_block", T.IntegerType())])).parquet(path)
    for i in range(n_blocks):
        yield kept.where(F.col("_block") == i).drop("_block").toArrow()


def in_passes(
    rows: DataFrame,
    queries: DataFrame,
    n_blocks: int,
    metric: str,
    k: int,
    flags: list[str],
    id_col: str,
    schema: str,
    choose: Callable[[Queries], Mapping] | None = None,
) -> DataFrame:
    """The winners of every task, for one block of queries after the other: the records are scanned, never shuffled."""
    # every block reads the records: what they are made by is run once
    rows = workspace.staged(rows, "records")
    found = None
    for part in blocks_of(queries, n_blocks):
        if len(part):
            made = _queries(part, k)
            used = [name for name in flags if name in made.groups]
            bucket = ["bucket"] if "bucket" in rows.columns else []
            one = per_task(rows.select(id_col, "vector", *used, *bucket), made, metric, used, id_col, schema, choose)
            found = one if found is None else found.union(one)
    return found


def block_worker(metric: str, k: int, flags: list[str], id_col: str, keys: Sequence[str]):
    """A function that finds the winners among one block of records, for one block of queries."""

    def work(records: pa.Table, asked: pa.Table) -> pa.Table:
        found = None
        if len(asked) and len(records):
            block = _queries(asked.drop_columns(list(keys)), k)
            winners = Winners(block, metric)
            used = [name for name in flags if name in block.groups]
            for batch in records.select([id_col, "vector", *used]).to_batches(max_chunksize=16_384):
                _offer(winners, block, batch, used)
            found = winners.batch(id_col)
        if found is None:
            names = ["query_id", id_col, "score"]
            types = [asked.schema.field("query_id").type, records.schema.field(id_col).type, pa.float64()]
            return pa.table([pa.array([], t) for t in types], names=names)
        return found

    return work


def _queries(table: pa.Table, k: int) -> Queries:
    keys = _whole(table["query_id"])
    limits = np.full(len(keys), k)
    if "top_k" in table.column_names:
        own = table["top_k"].to_numpy(zero_copy_only=False)
        limits = np.array([arguments.top_k(None if v is None or v != v else int(v)) for v in own])
    groups: dict = {}
    if "filter_name" in table.column_names:
        names = np.array(table["filter_name"].to_pylist(), dtype=object)
        groups = {name: np.flatnonzero(names == name) for name in set(names.tolist())}
    if "_buckets" in table.column_names:
        lists = _whole(table["_buckets"])
        asking = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        buckets = lists.flatten().to_numpy()
        order = np.argsort(buckets, kind="stable")
        values, starts = np.unique(buckets[order], return_index=True)
        groups = dict(zip(values.tolist(), np.split(asking[order], starts[1:]), strict=True)) if len(values) else {None: np.empty(0, dtype=np.int64)}
    bounds = table["_last"].to_numpy() if "_last" in table.column_names else None
    return Queries(keys, matrix(table["vector"]), limits, groups, bounds)


def block_count(n: int, size: int, k: int, broadcast_bytes: int, block_winners: int = _BLOCK_WINNERS) -> int:
    """Into how many blocks n queries of so many bytes are cut."""
    return max(1, min(n, math.ceil(max(n * size / max(broadcast_bytes, 1), n * k / block_winners))))


def search_batch(
    coll: DataFrame,
    queries: DataFrame,
    top_k: int | None = None,
    *,
    where: Mapping | None = None,
    filters: Mapping[str, Mapping] | None = None,
    metric: str = "cosine",
    score_threshold: float | None = None,
    payload: Sequence[str] = (),
    with_vector: bool = False,
    id_col: str = "id",
    vector_col: str = "vector",
    broadcast_bytes: int = sizing.QUERY_BROADCAST_BYTES,
    block_winners: int = _BLOCK_WINNERS,
) -> DataFrame:
    """The nearest records to every query: ``query_id, id, score, rank`` and the payload columns asked for.

    ``queries`` has ``query_id`` and ``vector``, and may have ``top_k`` (its own number of results),
    ``score_threshold`` (its own, beside the one for all) and ``filter_name`` (its own filter, by name from
    ``filters``). ``where`` holds for all of them.
    """
    k = arguments.top_k(top_k)
    metric = vectors.check_metric(metric)
    own_filter = "filter_name" in queries.columns
    wanted = ["query_id", "vector", *[c for c in ("top_k", "filter_name") if c in queries.columns]]
    asked = queries.select(*wanted).withColumn("vector", plain(queries, "vector"))
    known = {_FLAG: {}, **{_FLAG + name: flt for name, flt in (filters or {}).items()}}
    if own_filter:
        # A query without a filter looks at every record.
        asked = asked.withColumn("filter_name", F.concat(F.lit(_FLAG), F.coalesce("filter_name", F.lit(""))))
    facts = [F.count(F.lit(1)), F.min(F.size("vector")), F.max(F.size("vector"))]
    facts.append(F.max("top_k") if "top_k" in wanted else F.lit(None))
    large = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) > _LARGE / 1e10))
    facts.append(F.count_if(F.col("vector").isNull() | large))
    facts.append(F.collect_set("filter_name") if own_filter else F.lit(None))
    n_queries, dim, longest, most, missing, names = asked.agg(*facts).first()
    if missing or (n_queries and (dim != longest or dim < 1)):
        raise RecordError("the query vectors must not be empty, must have one dimension and finite elements of usual size")
    if "top_k" in wanted:
        k = max(arguments.top_k(most), arguments.DEFAULT_TOP_K)
    flags = sorted(names) if own_filter and names else []
    unknown = [name for name in flags if name not in known]
    if unknown:
        raise RecordError(f"no filter is named {unknown[0].removeprefix(_FLAG)!r}")

    chosen = coll.where(predicate(coll, where)) if where else coll
    tests = {name: predicate(coll, known[name]) for name in flags}
    if tests:
        chosen = chosen.where(_either(list(tests.values())))
    rows = chosen.select(
        id_col, plain(coll, vector_col).alias("vector"), *[t.alias(n) for n, t in tests.items()]
    )
    types = {**dict(coll.dtypes), "query_id": dict(queries.dtypes)["query_id"]}
    schema = f"query_id {types['query_id']}, `{id_col}` {types[id_col]}, score double"

    tasks = sizing.scan_tasks(coll)
    few = n_queries * k * _WINNER_BYTES <= sizing.RESULT_BROADCAST_BYTES
    if n_queries == 0:
        found = coll.sparkSession.createDataFrame([], schema)
    elif (n_blocks := block_count(n_queries, dim * 8, k, broadcast_bytes, block_winners)) <= 1:
        fewer = sizing.winner_tasks(coll.sparkSession, tasks, n_queries * k * _WINNER_BYTES)
        if fewer < tasks:
            tasks, rows = fewer, rows.coalesce(fewer)
        found = per_task(rows, _queries(asked.toArrow(), k), metric, flags, id_col, schema)
    else:
        found = in_passes(rows, asked, n_blocks, metric, k, flags, id_col, schema)
    ranked = ranking.best_per_query(found, k, metric, id_col, tasks)
    if score_threshold is not None:
        ranked = ranked.where(ranking.beyond(metric, score_threshold))
    if "top_k" in wanted:
        # Every task has kept what each query asked for; the merged list is cut to the same number.
        own = F.coalesce(F.nullif(F.col("top_k"), F.lit(0)), F.lit(arguments.DEFAULT_TOP_K))
        own = asked.select("query_id", own.alias("_own"))
        ranked = ranked.join(F.broadcast(own) if few else own, "query_id").where(F.col("rank") <= F.col("_own"))
    if "score_threshold" in queries.columns:
        own = queries.where("score_threshold IS NOT NULL").select("query_id", F.col("score_threshold").cast("double").alias("_least"))
        ranked = ranked.join(F.broadcast(own) if few else own, "query_id", "left")
        ranked = ranked.where(F.col("_least").isNull() | ranking.beyond(metric, F.col("_least")))
    ranked = ranked.select("query_id", id_col, "score", "rank")
    payload = [*payload, *([vector_col] if with_vector and vector_col not in payload else [])]
    if payload:
        # The number of results is known beforehand: few of them go to the payload, which stays where it is.
        ranked = coll.select(id_col, *payload).join(F.broadcast(ranked) if few else ranked, id_col)
    return ranked.select("query_id", id_col, "score", "rank", *payload)


def _either(tests: list):
    either = tests[0]
    for test in tests[1:]:
        either = either | test
    return either
